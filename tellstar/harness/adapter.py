"""Landing tree derived from the driver tables (the stand-in input of every harness query).

``landing_root`` writes, with Spark, the producer layout the library reads:

* one manifest per run (run = event type x day) in the new batch folder, plus an older,
  different copy for early runs in an old batch folder (exercises newest-batch-wins)
* one ``<run_id>.jsonl`` per run with one answer per event (some lines padded with
  whitespace and followed by a blank line, exercising line skipping and ``line_no``)
* the question bank (``reference/questions.jsonl``, written as a folder of parts)
* one corpus profile per ``supplier`` row, and price catalogs grouped from ``part`` rows

It does none of the pipeline's work: values come from ``formulas`` only. The landing
tree, the raw landing and the marts built from it are cached under the cluster's
checkpoint folder, keyed by a fingerprint of the input folder and of this package's code.
"""

from __future__ import annotations

import hashlib
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.landing import land_all
from ..plans.marts import build_star
from ..session import compiled_methods, workspace_dir
from ..sources import fs
from ..sources.sinks import write_named_documents, write_named_text
from . import formulas as fm


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_base(spark: SparkSession, sf_dir: str, replicas: int = 1) -> DataFrame:
    """Typed base rows; ``replicas`` > 1 (bench scale-up only) turns each event into that
    many answers with distinct ids (``eid * replicas + r``)."""
    ev = table(spark, sf_dir, "events")
    if replicas > 1:
        ev = ev.select(F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("_r"), "*").withColumn(
            "event_id", F.col("event_id") * replicas + F.col("_r")).drop("_r")
    return spark.sql(fm.ev_sql("spark", "{ev}"), ev=ev)


def _struct(fields: list[tuple[str, str]], rename: dict[str, str] | None = None) -> F.Column:
    rename = rename or {}
    return F.struct(*[F.expr(expr).alias(rename.get(name, name)) for name, expr in fields])


def _write_named(df, parts, staging, dest_for, value=None):
    return write_named_text(df, parts, staging, dest_for, order="_order", value=value)


def _write_documents(df, parts, staging, dest_for):
    return write_named_documents(df, parts, staging, dest_for, order="_order")


def write_landing(spark: SparkSession, sf_dir: str, root: str, replicas: int = 1) -> None:
    root = root.rstrip("/")
    compiled_methods(spark)
    ev = events_base(spark, sf_dir, replicas)
    # the five parts are independent jobs, submitted together below
    jobs: list[Callable[[], object]] = []

    # ---- manifests (run = event type x day)
    runs = ev.select("et", "d", "ymd", "ymd_dash").distinct()
    run_cols = fm.run_fields("spark")
    new = runs.select(
        F.expr("et || '-' || ymd").alias("run_id"),
        F.lit(fm.NEW_BATCH).alias("batch"),
        F.to_json(_struct(run_cols)).alias("value"),
        F.lit(0).alias("_order"),
    )
    old_cols = [(n, "'harness-v0'" if n == "harness_version" else e) for n, e in run_cols]
    old = runs.where(F.col("d") <= fm.OLD_BATCH_DAYS).select(
        F.expr("et || '-' || ymd").alias("run_id"),
        F.lit(fm.OLD_BATCH).alias("batch"),
        F.to_json(_struct(old_cols)).alias("value"),
        F.lit(0).alias("_order"),
    )
    jobs.append(lambda: _write_documents(
        new.unionByName(old), ["batch", "run_id"], f"{root}/_staging_manifests",
        lambda v: f"{root}/{v['batch']}/{v['run_id']}.manifest.json",
    ))

    # ---- scored answers, one file per run, lines in event order
    trav = F.when(F.expr(fm.TRAVERSAL_PRESENT), _struct(fm.traversal_fields("spark")))
    answer = F.struct(
        *[F.expr(e).alias(n) for n, e in fm.answer_fields("spark")],
        F.expr("'gt-' || CAST(eid AS string)").alias("ground_truth"),
        F.expr("'answer ' || CAST(eid AS string)").alias("predicted"),
        trav.alias("traversal_info"),
        F.struct(F.lit("set").alias("basis"), F.expr("k % 3 = 0").alias("llm_called")).alias("judge_details"),
    )
    payload = F.to_json(answer)
    padded = F.when(F.col("eid") % 17 == 0, F.concat(F.lit("  "), payload, F.lit("\n   "))).otherwise(payload)
    # the lines are made of the dealt rows: they are ten times as long as these
    records = ev.select(
        "*",
        F.expr("et || '-' || ymd").alias("run_id"),
        F.lit(fm.NEW_BATCH).alias("batch"),
        F.col("eid").alias("_order"),
    )
    jobs.append(lambda: _write_named(
        records, ["batch", "run_id"], f"{root}/_staging_records",
        lambda v: f"{root}/{v['batch']}/{v['run_id']}.jsonl", value=padded,
    ))

    # ---- question bank (folder of parts; a question bank is not run-scoped)
    base = F.to_json(_struct(fm.question_fields("spark")))
    gt = F.expr(
        "CASE k % 5 WHEN 0 THEN '\"gt-' || CAST(eid AS string) || '\"' "
        "WHEN 1 THEN to_json(array('a-' || CAST(eid AS string), 'b-' || CAST(eid AS string))) "
        "WHEN 2 THEN '[]' "
        "WHEN 3 THEN to_json(array('', CAST(NULL AS string), 'c-' || CAST(eid AS string))) "
        "ELSE '[null]' END"
    )
    seeds = F.expr(
        "CASE WHEN k % 3 = 0 THEN '' WHEN k % 4 = 0 THEN ',\"seeds\":[]' "
        "ELSE ',\"seeds\":' || to_json(transform(sequence(1, k % 4), i -> 'ent-' || CAST(i AS string))) END"
    )
    qb = ev.where(F.expr(fm.QUESTION_PRESENT)).withColumn("_b", base)
    qb = qb.select(
        F.concat(F.expr("substr(_b, 1, length(_b) - 1)"), F.lit(',"ground_truth":'), gt, seeds, F.lit("}")).alias(
            "value"
        )
    )
    jobs.append(lambda: qb.write.mode("overwrite").text(f"{root}/reference/questions.jsonl"))

    # ---- corpus profiles, one per supplier
    sup = table(spark, sf_dir, "supplier")
    pf = dict(fm.profile_fields("spark"))
    graph = F.struct(
        F.lit("ontology/graph.ttl").alias("ttl_path"),
        F.expr(pf["graph_ttl_bytes"]).alias("ttl_bytes"),
        F.expr(pf["graph_ttl_sha256"]).alias("ttl_sha256"),
        F.expr(f"CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'http://graph.invalid/sparql' END").alias("endpoint"),
        F.expr(pf["graph_triples"]).alias("triples"),
        F.expr(pf["graph_nodes"]).alias("nodes"),
        F.expr(pf["graph_edges"]).alias("edges"),
        F.lit("profile").alias("source"),
    )
    vector = F.struct(
        F.lit("data/chroma").alias("chroma_path"),
        F.lit("abstracts").alias("collection"),
        F.expr(pf["vector_store_bytes"]).alias("store_bytes"),
        F.expr(pf["vector_n_chunks"]).alias("n_chunks"),
        F.expr(pf["vector_n_abstracts"]).alias("n_abstracts"),
        F.expr(pf["vector_n_words"]).alias("n_words"),
        F.lit("data/abstracts").alias("abstracts_dir"),
        F.expr(pf["vector_embed_model"]).alias("embed_model"),
        F.expr(pf["vector_chunk_size"]).alias("chunk_size"),
        F.expr(pf["vector_chunk_overlap"]).alias("chunk_overlap"),
    )
    prof = sup.select(
        F.expr(pf["corpus_build_id"]).alias("cid"),
        F.to_json(
            F.struct(
                F.expr(pf["corpus_build_id"]).alias("corpus_build_id"),
                F.expr(pf["scale"]).alias("scale"),
                F.expr(pf["measured_at"]).alias("measured_at"),
                graph.alias("graph"),
                vector.alias("vector"),
            )
        ).alias("value"),
        F.lit(0).alias("_order"),
    )
    jobs.append(lambda: _write_documents(
        prof, ["cid"], f"{root}/_staging_profiles", lambda v: f"{root}/reference/{v['cid']}.json"))

    # ---- price catalogs: parts grouped into bounded provider documents
    pr = dict(fm.price_fields("spark"))
    part = table(spark, sf_dir, "part")

    def price(expr: str) -> F.Column:
        return F.when(F.expr(expr).isNotNull(), F.struct(F.expr(expr).alias("price")))

    paygo = F.struct(
        price(pr["request"]).alias("request_token"),
        price(pr["response"]).alias("response_token"),
        price(pr["cache_read"]).alias("cache_read_input_token"),
        price(pr["cache_write"]).alias("cache_write_input_token"),
    )
    batch_cfg = F.struct(price(pr["request"]).alias("request_token"))
    entries = part.select(
        F.expr(pr["provider"]).alias("provider"),
        F.concat(
            F.lit('"'), F.expr(pr["model_key"]), F.lit('":'),
            F.to_json(F.struct(F.struct(paygo.alias("pay_as_you_go"), batch_cfg.alias("batch_config")).alias(
                "pricing_config"))),
        ).alias("entry"),
    )
    docs = entries.groupBy("provider").agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws(",", F.sort_array(F.collect_list("entry"))).alias("models")
    )
    meta = F.to_json(
        F.struct(
            F.col("provider"),
            F.lit(fm.FETCHED_AT).alias("fetched_at"),
            F.lit(fm.CATALOG_REF).alias("ref"),
            F.concat(F.lit("catalog/"), F.col("provider"), F.lit(".json")).alias("source_url"),
            F.col("n").alias("model_count"),
        )
    )
    doc = docs.select(
        "provider",
        F.concat(F.lit('{"meta":'), meta, F.lit(',"models":{'), F.col("models"), F.lit("}}")).alias("value"),
        F.lit(0).alias("_order"),
    )
    jobs.append(lambda: _write_documents(doc, ["provider"], f"{root}/_staging_pricing",
                                         lambda v: f"{root}/reference/pricing/{v['provider']}.json"))
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


_LOCK = threading.RLock()
_CODE_HASH: str | None = None


def _code_hash() -> str:
    """Fingerprint of this package's source, so a cache never outlives a code change."""
    global _CODE_HASH
    if _CODE_HASH is None:
        h = hashlib.md5()
        pkg = Path(__file__).resolve().parents[1]
        for f in sorted(pkg.rglob("*.py")) + sorted(pkg.rglob("*.csv")):
            h.update(f.read_bytes())
        _CODE_HASH = h.hexdigest()[:12]
    return _CODE_HASH


def _cache_base(spark: SparkSession) -> str:
    """Stable cache folder under the cluster's checkpoint folder (shared by every session
    of the cluster); the per-context scratch folder when none is configured (tests)."""
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/") + "/tellstar-cache"
    return workspace_dir(spark) + "/cache"


def _once(spark: SparkSession, kind: str, sf_dir: str, build, wait_s: int = 3600) -> str:
    """Build a cached stage folder once; reused by later calls and other sessions.

    The key fingerprints the input folder (file names, sizes, times) and the package
    code. The first caller takes an exclusive lock file; concurrent callers wait for its
    ``_READY`` marker, and take over when the lock is older than ``wait_s`` seconds."""
    with _LOCK:
        base_dir = sf_dir.split("#")[0]
        key = hashlib.md5(f"{sf_dir}|{fs.stamp(spark, base_dir)}|{_code_hash()}".encode()).hexdigest()[:16]
        path = f"{_cache_base(spark)}/{kind}/{key}"
        ready = f"{path}/_READY"
        if fs.exists(spark, ready):
            return path
        if fs.create_exclusive(spark, f"{path}/_LOCK", "building"):
            try:
                build(path)
            except BaseException:
                fs.delete(spark, path)  # release the lock and the partial build
                raise
            fs.write_text(spark, ready, "ok")
            return path
        lock = f"{path}/_LOCK"
        while not fs.exists(spark, ready):
            # a builder that was killed leaves its lock: one as old as ``wait_s`` is taken over
            if fs.exists(spark, lock) and fs.age_seconds(spark, lock) > wait_s:
                fs.delete(spark, path)
            if not fs.exists(spark, lock):
                return _once(spark, kind, sf_dir, build, wait_s)
            time.sleep(2)
        return path


def landing_root(spark: SparkSession, sf_dir: str, replicas: int = 1) -> str:
    key = sf_dir if replicas == 1 else f"{sf_dir}#x{replicas}"
    return _once(spark, "landing", key, lambda p: write_landing(spark, sf_dir, p, replicas))


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, "raw", sf_dir, lambda p: land_all(spark, landing_root(spark, sf_dir), p))


def _build_marts(spark: SparkSession, sf_dir: str, path: str) -> None:
    from ..plans.reports import materialize_analysis

    build_star(spark, raw_root(spark, sf_dir), path)
    materialize_analysis(spark, path)


def marts_root(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, "marts", sf_dir, lambda p: _build_marts(spark, sf_dir, p))
