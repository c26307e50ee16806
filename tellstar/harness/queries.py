"""Harness registry: one Spark query and (where SQL can express it) one DuckDB oracle per
inventory key. Every query runs the library on the landing tree / raw tables / marts that
Spark derives from the driver tables (see ``adapter``), or on a driver table directly for
the relational twins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import model_family, surrogate_key
from ..functions.jsonx import ground_truth_text, is_json_array, jsub, jtext, jtyped, parsed
from ..functions.scalars import split_part_or_empty, starts_with_or_false
from ..operators import aggregates as agg
from ..operators import landing as ld
from ..operators import quality as dq
from ..operators.joins import null_aware_anti_join, orphans
from ..plans import marts as mt
from ..plans import reports as rp
from ..plans import staging as st
from ..plans.intermediate import join_traversal
from ..sources import landing_files as lf
from ..sources.seeds import read_seed, seed
from ..operators.ordinality import row_positions
from ..sources.tables import read_table
from . import adapter
from . import formulas as fm
from .oracle import q as oq

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def O(final: str, doubles: tuple[str, ...] = ()) -> str:  # noqa: E743
    """Oracle SQL: prelude CTEs + final select, doubles rounded like the Spark side."""
    if doubles:
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
        final = f"SELECT * REPLACE ({rep}) FROM ({final}) _o"
    return oq(final)


def reg(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = (fn, oracle)
        return fn

    return deco


# ------------------------------------------------------------------ accessors

def _landing(spark, sf):
    return adapter.landing_root(spark, sf)


def _pipe(spark, sf) -> mt.Relations:
    return mt.Relations(spark, adapter.raw_root(spark, sf))


def _mart(spark, sf, name, doubles=True):
    m = adapter.marts_root(spark, sf)
    return mt.load_mart(spark, m, name) if doubles else read_table(spark, f"{m}/{name}")


def _af(spark, sf):
    return rp.analysis_frame(spark, adapter.marts_root(spark, sf))


def _enriched(spark, sf):
    return read_table(spark, f"{adapter.marts_root(spark, sf)}/_int/int_scored_answers_enriched")


def _table(spark, sf, name):
    return adapter.table(spark, sf, name)


NEW, OLD = fm.NEW_BATCH, fm.OLD_BATCH

# ================================================================== S: scans / sources

@reg("scan_manifests", O(f"""
    SELECT run_id, '{NEW}' AS batch, '{NEW}/' || run_id || '.manifest.json' AS relative_uri, harness_version FROM runs
    UNION ALL
    SELECT run_id, '{OLD}', '{OLD}/' || run_id || '.manifest.json', 'harness-v0' FROM runs WHERE d <= {fm.OLD_BATCH_DAYS}"""))
def q_scan_manifests(spark, sf):
    root = _landing(spark, sf)
    m = lf.scan_manifests(spark, root)
    return m.select("run_id", "batch", lf.relative_uri("source_uri", root).alias("relative_uri"),
                    jtext(parsed("payload"), "harness_version").alias("harness_version"))


@reg("dedupe_run_batches", O(f"SELECT run_id, '{NEW}' AS batch, harness_version FROM runs"))
def q_dedupe(spark, sf):
    m = lf.dedupe_run_batches(lf.scan_manifests(spark, _landing(spark, sf)))
    return m.select("run_id", "batch", jtext(parsed("payload"), "harness_version").alias("harness_version"))


@reg("scan_records", O(f"SELECT run_id, '{NEW}' AS batch, line_no, question_id FROM sa"))
def q_scan_records(spark, sf):
    r = lf.scan_record_lines(spark, _landing(spark, sf))
    return r.select("run_id", "batch", "line_no", jtext(parsed("payload"), "question_id").alias("question_id"))


@reg("scan_questions", O("SELECT question_id, type_id FROM questions"))
def q_scan_questions(spark, sf):
    v = parsed("payload")
    return lf.scan_questions(spark, _landing(spark, sf)).select(
        jtext(v, "question_id").alias("question_id"), jtext(v, "type_id").alias("type_id"))


@reg("scan_corpus_profiles", O("SELECT corpus_build_id, corpus_scale AS scale FROM profiles"))
def q_scan_profiles(spark, sf):
    p = lf.scan_corpus_profiles(spark, _landing(spark, sf))
    return p.select("corpus_build_id", jtext(parsed("payload"), "scale").alias("scale"))


@reg("scan_pricing", O("SELECT provider, CAST(count(*) AS BIGINT) AS model_count FROM catalog GROUP BY provider"))
def q_scan_pricing(spark, sf):
    p = lf.scan_pricing(spark, _landing(spark, sf))
    return p.select("provider", jtyped(parsed("payload"), "meta.model_count", "bigint").alias("model_count"))


@reg("source_uri", O(f"""
    SELECT 'run_manifest' AS kind, run_id AS key, '{NEW}/' || run_id || '.manifest.json' AS relative_uri FROM runs
    UNION ALL SELECT 'corpus_profile', corpus_build_id, 'reference/' || corpus_build_id || '.json' FROM profiles
    UNION ALL SELECT DISTINCT 'model_pricing', provider, 'reference/pricing/' || provider || '.json' FROM catalog"""))
def q_source_uri(spark, sf):
    root = _landing(spark, sf)
    m = lf.dedupe_run_batches(lf.scan_manifests(spark, root)).select(
        F.lit("run_manifest").alias("kind"), F.col("run_id").alias("key"), "source_uri")
    c = lf.scan_corpus_profiles(spark, root).select(
        F.lit("corpus_profile").alias("kind"), F.col("corpus_build_id").alias("key"), "source_uri")
    p = lf.scan_pricing(spark, root).select(F.lit("model_pricing").alias("kind"), F.col("provider").alias("key"),
                                            "source_uri")
    return m.unionByName(c).unionByName(p).select("kind", "key", lf.relative_uri("source_uri", root).alias(
        "relative_uri"))


@reg("scan_seed_retriever_labels", O("""
    SELECT s.retriever, CAST(count(*) AS BIGINT) AS n_answers, l.retriever_family, l.is_graph, l.display_label,
           l.sort_order
    FROM sa s LEFT JOIN retriever_labels l ON s.retriever = l.retriever
    GROUP BY s.retriever, l.retriever_family, l.is_graph, l.display_label, l.sort_order"""))
def q_seed_retriever(spark, sf):
    a = _pipe(spark, sf).raw("scored_answer").select(jtext(parsed("payload"), "retriever").alias("retriever"))
    counts = a.groupBy("retriever").agg(F.count(F.lit(1)).alias("n_answers"))
    return counts.join(seed(spark, "seed_retriever_labels"), "retriever", "left").select(
        "retriever", "n_answers", "retriever_family", "is_graph", "display_label", "sort_order")


@reg("scan_seed_scoring_labels", O("""
    SELECT s.scoring, CAST(count(*) AS BIGINT) AS n_answers, l.scoring_family, l.display_label
    FROM sa s LEFT JOIN scoring_labels l ON s.scoring = l.scoring GROUP BY ALL"""))
def q_seed_scoring(spark, sf):
    a = _pipe(spark, sf).raw("scored_answer").select(jtext(parsed("payload"), "scoring").alias("scoring"))
    counts = a.groupBy("scoring").agg(F.count(F.lit(1)).alias("n_answers"))
    return counts.join(seed(spark, "seed_scoring_labels"), "scoring", "left").select(
        "scoring", "n_answers", "scoring_family", "display_label")


@reg("scan_seed_question_type_labels", O("""
    SELECT q.type_id, CAST(count(*) AS BIGINT) AS n_questions, l.type_family, l.display_label, l.description
    FROM questions q LEFT JOIN type_labels l ON q.type_id = l.type_id GROUP BY ALL"""))
def q_seed_types(spark, sf):
    qs = _pipe(spark, sf).questions()
    counts = qs.groupBy("type_id").agg(F.count(F.lit(1)).alias("n_questions"))
    return counts.join(seed(spark, "seed_question_type_labels"), "type_id", "left").select(
        "type_id", "n_questions", "type_family", "display_label", "description")


@reg("scan_seed_pricing_overrides", O("""
    SELECT o.provider, o.model_resolved, o.input_usd_per_mtok, o.output_usd_per_mtok, o.effective_date,
           CAST(count(s.question_id) AS BIGINT) AS n_answers
    FROM overrides o LEFT JOIN sa s ON s.generator_model_resolved = o.model_resolved GROUP BY ALL"""))
def q_seed_overrides(spark, sf):
    a = _pipe(spark, sf).raw("scored_answer").select(
        jtext(parsed("payload"), "generator_model_resolved").alias("model_resolved"))
    used = a.groupBy("model_resolved").agg(F.count(F.lit(1)).alias("n_answers"))
    o = seed(spark, "seed_pricing_local_overrides")
    return o.join(used, "model_resolved", "left").select(
        "provider", "model_resolved", "input_usd_per_mtok", "output_usd_per_mtok", "effective_date",
        F.coalesce("n_answers", F.lit(0)).cast("bigint").alias("n_answers"))


@reg("scan_seed_model_alias", O("""
    SELECT CAST(count(*) AS BIGINT) AS n_catalog_models, CAST(0 AS BIGINT) AS n_aliased FROM catalog"""))
def q_seed_alias(spark, sf):
    alias = read_seed(spark, "seed_pricing_model_alias")
    cat = st.explode_catalog(_pipe(spark, sf).raw("model_pricing")).select("portkey_model_key")
    j = cat.join(F.broadcast(alias), "portkey_model_key", "left")
    return j.agg(F.count(F.lit(1)).alias("n_catalog_models"),
                 F.count("model_resolved").cast("bigint").alias("n_aliased"))


@reg("load_mart", O("""
    SELECT pricing_sk, model_resolved, CAST(input_usd_per_mtok AS DOUBLE) AS input_usd_per_mtok,
           CAST(output_usd_per_mtok AS DOUBLE) AS output_usd_per_mtok,
           CAST(cache_read_usd_per_mtok AS DOUBLE) AS cache_read_usd_per_mtok,
           CAST(cache_write_usd_per_mtok AS DOUBLE) AS cache_write_usd_per_mtok FROM pricing""",
    ("input_usd_per_mtok", "output_usd_per_mtok", "cache_read_usd_per_mtok", "cache_write_usd_per_mtok")))
def q_load_mart(spark, sf):
    return _mart(spark, sf, "dim_token_pricing").select(
        "pricing_sk", "model_resolved", "input_usd_per_mtok", "output_usd_per_mtok",
        "cache_read_usd_per_mtok", "cache_write_usd_per_mtok")


# ================================================================== K: sinks / landing

def _fresh(spark, kind: str) -> str:
    """A new folder under the session's scratch folder for a query that writes."""
    import uuid

    from ..session import workspace_dir

    return f"{workspace_dir(spark)}/{kind}/{uuid.uuid4().hex}"


@reg("land_runs", O("""
    SELECT run_id, CAST(count(*) AS BIGINT) AS n_records, min(line_no) AS min_line_no, max(line_no) AS max_line_no
    FROM sa GROUP BY run_id"""))
def q_land_runs(spark, sf):
    """K1 runs here: every run of the landing tree is landed into a fresh raw folder."""
    raw_dir = _fresh(spark, "k1")
    ld.land_runs(spark, _landing(spark, sf), raw_dir)
    raw = ld.read_raw(spark, raw_dir, "scored_answer")
    return raw.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_records"), F.min("line_no").alias("min_line_no"),
                                     F.max("line_no").alias("max_line_no"))


@reg("land_questions", O("SELECT type_id, CAST(count(*) AS BIGINT) AS n_questions FROM questions GROUP BY type_id"))
def q_land_questions(spark, sf):
    """K2 runs here, into a fresh raw folder."""
    raw_dir = _fresh(spark, "k2")
    ld.land_questions(spark, _landing(spark, sf), raw_dir)
    raw = ld.read_raw(spark, raw_dir, "question")
    t = raw.select(jtext(parsed("payload"), "type_id").alias("type_id"))
    return t.groupBy("type_id").agg(F.count(F.lit(1)).alias("n_questions"))


@reg("land_corpus_profiles", O("SELECT corpus_build_id, 'reference/' || corpus_build_id || '.json' AS relative_uri FROM profiles"))
def q_land_profiles(spark, sf):
    """K3 runs here (upsert into a fresh raw folder)."""
    root = _landing(spark, sf)
    raw_dir = _fresh(spark, "k3")
    ld.land_corpus_profiles(spark, root, raw_dir)
    raw = ld.read_raw(spark, raw_dir, "corpus_profile")
    return raw.select("corpus_build_id", lf.relative_uri("source_uri", root).alias("relative_uri"))


@reg("land_pricing", O("SELECT DISTINCT provider, 'reference/pricing/' || provider || '.json' AS relative_uri FROM catalog"))
def q_land_pricing(spark, sf):
    """K4 runs here (upsert into a fresh raw folder)."""
    root = _landing(spark, sf)
    raw_dir = _fresh(spark, "k4")
    ld.land_pricing(spark, root, raw_dir)
    raw = ld.read_raw(spark, raw_dir, "model_pricing")
    return raw.select("provider", lf.relative_uri("source_uri", root).alias("relative_uri"))


@reg("land_all", O("""
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM runs) AS runs, (SELECT CAST(count(*) AS BIGINT) FROM sa) AS records,
           (SELECT CAST(count(*) AS BIGINT) FROM questions) AS questions,
           (SELECT CAST(count(*) AS BIGINT) FROM profiles) AS corpus_profiles,
           (SELECT CAST(count(DISTINCT provider) AS BIGINT) FROM catalog) AS pricing_snapshots"""))
def q_land_all(spark, sf):
    """K5 runs here into a fresh raw folder; the counts are read back from the tables."""
    raw_dir = _fresh(spark, "k5")
    ld.land_all(spark, _landing(spark, sf), raw_dir)
    p = mt.Relations(spark, raw_dir)
    counts = [p.raw(t).agg(F.count(F.lit(1)).alias(n)) for t, n in (
        ("run_manifest", "runs"), ("scored_answer", "records"), ("question", "questions"),
        ("corpus_profile", "corpus_profiles"), ("model_pricing", "pricing_snapshots"))]
    return agg.side_by_side(*counts)


@reg("raw_pk_guard", O("""
    SELECT run_id, question_id, CAST(count(*) AS BIGINT) AS n_rows FROM sa GROUP BY ALL HAVING count(*) > 1"""))
def q_pk_guard(spark, sf):
    return ld.duplicate_keys(_pipe(spark, sf).raw("scored_answer"), ["run_id", "question_id"])


@reg("pricing_snapshot_build", O(f"""
    SELECT provider, CAST(count(*) AS BIGINT) AS model_count, DATE '{fm.FETCHED_AT}' AS fetched_at,
           '{fm.CATALOG_REF}' AS ref FROM catalog GROUP BY provider"""))
def q_snapshot_build(spark, sf):
    """K7 runs here: catalogs are validated, wrapped with meta, written as
    ``reference/pricing/<provider>.json`` under a fresh root and read back by the scan."""
    from ..operators.pricing_snapshot import build_snapshots, write_snapshots

    raw = _pipe(spark, sf).raw("model_pricing")
    models = raw.select("provider", F.to_json(jsub(parsed("payload"), "models")).alias("models_json"))
    root = _fresh(spark, "k7")
    write_snapshots(build_snapshots(models, ref=fm.CATALOG_REF, fetched_at=fm.FETCHED_AT), root)
    v = parsed("payload")
    return lf.scan_pricing(spark, root).select(
        "provider", jtyped(v, "meta.model_count", "bigint").alias("model_count"),
        jtyped(v, "meta.fetched_at", "date").alias("fetched_at"), jtext(v, "meta.ref").alias("ref"))


@reg("materialize", O("""
    SELECT 'dim_run' AS mart, CAST(count(*) AS BIGINT) AS n_rows FROM dim_run
    UNION ALL SELECT 'dim_question', count(*) FROM dim_question
    UNION ALL SELECT 'dim_retriever_cond', count(*) FROM dim_retriever_cond
    UNION ALL SELECT 'dim_generator', count(*) FROM dim_generator
    UNION ALL SELECT 'dim_writer', count(*) FROM dim_writer
    UNION ALL SELECT 'dim_scoring', count(*) FROM dim_scoring
    UNION ALL SELECT 'dim_corpus', count(*) FROM dim_corpus
    UNION ALL SELECT 'dim_token_pricing', count(*) FROM dim_token_pricing
    UNION ALL SELECT 'fct_scored_answer', count(*) FROM fct"""))
def q_materialize(spark, sf):
    """K8 runs here: every mart is built from the raw tables into a fresh folder and read back."""
    marts_dir = _fresh(spark, "k8")
    mt.build_star(spark, adapter.raw_root(spark, sf), marts_dir)
    out = None
    for name in mt.MARTS:
        c = read_table(spark, f"{marts_dir}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("mart"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


@reg("missing_records", O(f"""SELECT run_id || '-lost' AS run_id, '{NEW}' AS batch FROM runs
    WHERE right(run_id, 1) IN ('0', '2', '4', '6', '8')"""))
def q_missing_records(spark, sf):
    """K9 on the landed manifests and as many more, of runs that have no records file."""
    root = _landing(spark, sf)
    there = lf.dedupe_run_batches(ld.valid_json(lf.scan_manifests(spark, root)))
    lost = there.where(F.substring("run_id", -1, 1).isin(*"02468")).withColumn("run_id", F.concat("run_id", F.lit("-lost")))
    return ld.missing_records(spark, root, there.unionByName(lost)).select("run_id", "batch")


# ================================================================== P: projections / scalar functions

@reg("json_text", O("SELECT run_id, question_id, retriever, scoring, verdict FROM sa"))
def q_json_text(spark, sf):
    v = parsed("payload")
    return _pipe(spark, sf).raw("scored_answer").select(
        "run_id", "question_id", jtext(v, "retriever").alias("retriever"), jtext(v, "scoring").alias("scoring"),
        jtext(v, "verdict").alias("verdict"))


@reg("json_path", O("SELECT corpus_build_id, triple_count, paper_count, embed_model FROM profiles"))
def q_json_path(spark, sf):
    v = parsed("payload")
    return _pipe(spark, sf).raw("corpus_profile").select(
        "corpus_build_id", jtyped(v, "graph.triples", "bigint").alias("triple_count"),
        jtyped(v, "vector.n_abstracts", "bigint").alias("paper_count"),
        jtext(v, "vector.embed_model").alias("embed_model"))


@reg("json_subdoc", O("""
    SELECT run_id, a_question_id AS question_id, ti_present AS has_traversal,
           CASE WHEN ti_present THEN t_mechanism END AS explicit_mechanism FROM ans"""))
def q_json_subdoc(spark, sf):
    v = parsed("payload")
    ti = jsub(v, "traversal_info")
    return _pipe(spark, sf).raw("scored_answer").select(
        "run_id", "question_id", ti.isNotNull().alias("has_traversal"),
        jtext(ti, "mechanism").alias("explicit_mechanism"))


@reg("typed_casts", O("SELECT run_id, run_ts, generator_temperature, num_questions FROM runs"))
def q_typed_casts(spark, sf):
    return _pipe(spark, sf).runs().select("run_id", "run_ts", "generator_temperature", "num_questions")


@reg("coalesce_default", O("SELECT run_id, question_id, generator_model_id, mechanism FROM sa"))
def q_coalesce_default(spark, sf):
    a = st.explode_answers(_pipe(spark, sf).raw("scored_answer"))
    return a.select("run_id", "question_id", "generator_model_id", "mechanism")


@reg("nullif_empty", O("SELECT run_id, question_id, error FROM sa"))
def q_nullif_empty(spark, sf):
    return st.stg_scored_answers(_pipe(spark, sf).raw("scored_answer")).select("run_id", "question_id", "error")


@reg("model_family", O("SELECT run_id, question_id, generator_model_family, writer_model_family FROM sa"))
def q_model_family(spark, sf):
    v = parsed("payload")
    gen = F.coalesce(jtext(v, "generator_model_resolved"), jtext(v, "generator_model"))
    return _pipe(spark, sf).raw("scored_answer").select(
        "run_id", "question_id", model_family(gen).alias("generator_model_family"),
        model_family(jtext(v, "traversal_info.writer_model")).alias("writer_model_family"))


_CUST_NAME = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END"


@reg("surrogate_key", O(f"""
    SELECT c_custkey, md5(concat_ws('|', coalesce(CAST(c_mktsegment AS varchar), '∅'),
        coalesce(CAST(c_nationkey AS varchar), '∅'), coalesce(CAST({_CUST_NAME} AS varchar), '∅'))) AS customer_sk
    FROM customer"""))
def q_surrogate_key(spark, sf):
    c = _table(spark, sf, "customer")
    return c.select("c_custkey", surrogate_key("c_mktsegment", "c_nationkey", F.expr(_CUST_NAME)).alias("customer_sk"))


@reg("case_mechanism", O("SELECT run_id, question_id, retriever, mechanism FROM sa"))
def q_case_mechanism(spark, sf):
    t = st.stg_traversal(_pipe(spark, sf).raw("scored_answer"))
    a = _pipe(spark, sf).raw("scored_answer").select(
        "run_id", "question_id", jtext(parsed("payload"), "retriever").alias("retriever"))
    return a.join(t.select("run_id", "question_id", "mechanism"), ["run_id", "question_id"])


@reg("hop_count", O("SELECT question_id, type_id, question_hop_count FROM questions"))
def q_hop_count(spark, sf):
    return _pipe(spark, sf).questions().select("question_id", "type_id", "question_hop_count")


@reg("split_part", O("""
    SELECT o_orderkey, split_part(coalesce(o_orderpriority, ''), '-', 1) AS priority_rank,
           split_part(coalesce(o_orderpriority, ''), '-', 2) AS priority_name,
           split_part(coalesce(o_orderpriority, ''), '-', 3) AS missing_part FROM orders"""))
def q_split_part(spark, sf):
    o = _table(spark, sf, "orders")
    return o.select("o_orderkey", split_part_or_empty("o_orderpriority", "-", 1).alias("priority_rank"),
                    split_part_or_empty("o_orderpriority", "-", 2).alias("priority_name"),
                    split_part_or_empty("o_orderpriority", "-", 3).alias("missing_part"))


@reg("ground_truth_text", O("SELECT question_id, ground_truth_answer_text FROM questions"))
def q_ground_truth_text(spark, sf):
    return _pipe(spark, sf).raw("question").select(
        "question_id", ground_truth_text(parsed("payload")).alias("ground_truth_answer_text"))


@reg("json_typeof", O("SELECT question_id, (k % 5 <> 0) AS ground_truth_is_array FROM questions"))
def q_json_typeof(spark, sf):
    return _pipe(spark, sf).raw("question").select(
        "question_id", is_json_array(jsub(parsed("payload"), "ground_truth")).alias("ground_truth_is_array"))


@reg("json_array_length", O("SELECT question_id, num_seed_entities FROM questions"))
def q_json_array_length(spark, sf):
    return _pipe(spark, sf).questions().select("question_id", "num_seed_entities")


@reg("concat_provenance", O("SELECT provider, model_resolved, source_note FROM catalog"))
def q_concat_provenance(spark, sf):
    return _pipe(spark, sf).stg_pricing().select("provider", "model_resolved", "source_note")


@reg("unit_convert", O("""SELECT model_resolved, input_usd_per_mtok, output_usd_per_mtok, cache_read_usd_per_mtok,
    cache_write_usd_per_mtok FROM catalog"""))
def q_unit_convert(spark, sf):
    return _pipe(spark, sf).stg_pricing().select(
        "model_resolved", "input_usd_per_mtok", "output_usd_per_mtok", "cache_read_usd_per_mtok",
        "cache_write_usd_per_mtok")


@reg("token_cost", O("SELECT run_id, question_id, generator_cost_usd, writer_cost_usd FROM enriched"))
def q_token_cost(spark, sf):
    return _pipe(spark, sf).enriched().select("run_id", "question_id", "generator_cost_usd", "writer_cost_usd")


@reg("total_cost", O("SELECT scored_answer_sk, total_cost_usd FROM fct"))
def q_total_cost(spark, sf):
    return _mart(spark, sf, "fct_scored_answer", doubles=False).select("scored_answer_sk", "total_cost_usd")


@reg("token_latency_totals", O("""SELECT scored_answer_sk, generator_total_tokens, writer_total_tokens,
    total_latency_ms FROM fct""", ("total_latency_ms",)))
def q_token_latency(spark, sf):
    return _mart(spark, sf, "fct_scored_answer", doubles=False).select(
        "scored_answer_sk", "generator_total_tokens", "writer_total_tokens", "total_latency_ms")


@reg("predicates_as_columns", O("""
    SELECT run_id, question_id, is_error, generator_provider = 'ollama' AS is_local FROM enriched"""))
def q_predicates(spark, sf):
    from ..functions.scalars import is_local_provider

    e = _pipe(spark, sf).enriched()
    return e.select("run_id", "question_id", "is_error", is_local_provider("generator_provider").alias("is_local"))


@reg("literal_tags", O("SELECT model_resolved, rate_unit, pricing_source FROM pricing"))
def q_literal_tags(spark, sf):
    return _pipe(spark, sf).pricing().select("model_resolved", "rate_unit", "pricing_source")


@reg("passed_flag", O("SELECT scored_answer_sk, passed FROM af"))
def q_passed_flag(spark, sf):
    return _af(spark, sf).select("scored_answer_sk", "passed")


@reg("total_tokens", O("SELECT scored_answer_sk, total_tokens FROM af"))
def q_total_tokens(spark, sf):
    return _af(spark, sf).select("scored_answer_sk", "total_tokens")


@reg("label_fallback", O("""
    SELECT f.scored_answer_sk, af.type_display_label, coalesce(q.type_description, '—') AS type_description
    FROM fct f JOIN af USING (scored_answer_sk) LEFT JOIN dim_question q ON f.question_sk = q.question_sk"""))
def q_label_fallback(spark, sf):
    a = _af(spark, sf).select("scored_answer_sk", "question_sk", "type_display_label")
    dq_ = _mart(spark, sf, "dim_question").select("question_sk", "type_description")
    return a.join(dq_, "question_sk", "left").select(
        "scored_answer_sk", "type_display_label",
        F.coalesce("type_description", F.lit(rp.NO_VALUE)).alias("type_description"))


_B3 = """SELECT display_label, sort_order, coalesce(sum(total_cost_d), 0.0) AS total_cost,
        CAST(sum(passed) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS total,
        avg(retrieval_latency_ms) AS avg_retrieval_ms, avg(generation_latency_ms) AS avg_generation_ms
    FROM af WHERE NOT coalesce(retriever IN ('graph_neighborhood'), FALSE)
      AND display_label IS NOT NULL AND sort_order IS NOT NULL
    GROUP BY display_label, sort_order"""
_B3_FULL = f"""SELECT *, correct / total AS accuracy,
        CASE WHEN correct > 0 THEN total_cost / correct END AS cost_per_correct,
        coalesce(avg_retrieval_ms, 0) + coalesce(avg_generation_ms, 0) AS avg_latency_ms FROM ({_B3}) b"""
_B3_D = ("total_cost", "avg_retrieval_ms", "avg_generation_ms", "accuracy", "cost_per_correct", "avg_latency_ms")


@reg("guarded_ratio", O(f"SELECT display_label, cost_per_correct FROM ({_B3_FULL}) x", ("cost_per_correct",)))
def q_guarded_ratio(spark, sf):
    return rp.report_cost_per_correct(_af(spark, sf)).select("display_label", "cost_per_correct")


@reg("starts_with", O("""
    SELECT scored_answer_sk, coalesce(starts_with(writer_model, 'claude-haiku-4-5'), FALSE) AS writer_is_fixed_family
    FROM af"""))
def q_starts_with(spark, sf):
    return _af(spark, sf).select(
        "scored_answer_sk", starts_with_or_false("writer_model", rp.HAIKU_FAMILY).alias("writer_is_fixed_family"))


_B6_WIDE = """SELECT display_label, sort_order, avg(retrieval_latency_ms) AS Retrieval,
        avg(generation_latency_ms) AS Generation, CAST(count(*) AS BIGINT) AS n
    FROM af WHERE generator_model_family = 'claude-haiku-4-5'
      AND NOT coalesce(retriever IN ('graph_neighborhood'), FALSE)
      AND display_label IS NOT NULL AND sort_order IS NOT NULL GROUP BY display_label, sort_order"""
_B6 = f"""SELECT display_label, sort_order, n, 'Retrieval' AS phase, Retrieval AS avg_latency_ms, 0 AS phase_order
    FROM ({_B6_WIDE}) w UNION ALL
    SELECT display_label, sort_order, n, 'Generation', Generation, 1 FROM ({_B6_WIDE}) w"""


@reg("value_map", O(f"SELECT display_label, phase, phase_order FROM ({_B6}) x"))
def q_value_map(spark, sf):
    return rp.report_latency_split(_af(spark, sf)).select("display_label", "phase", "phase_order")


_B8 = """SELECT provider, model_resolved, CAST(input_usd_per_mtok AS DOUBLE) AS input_usd_per_mtok,
        CAST(output_usd_per_mtok AS DOUBLE) AS output_usd_per_mtok,
        CAST(cache_read_usd_per_mtok AS DOUBLE) AS cache_read_usd_per_mtok,
        CAST(cache_write_usd_per_mtok AS DOUBLE) AS cache_write_usd_per_mtok, effective_date, pricing_source
    FROM dim_token_pricing"""
_B8_D = ("input_usd_per_mtok", "output_usd_per_mtok", "cache_read_usd_per_mtok", "cache_write_usd_per_mtok")


@reg("rename_project", O(f"""
    SELECT provider AS "Provider", model_resolved AS "Model", input_usd_per_mtok AS "Input $/Mtok",
        output_usd_per_mtok AS "Output $/Mtok", cache_read_usd_per_mtok AS "Cache-read $/Mtok",
        cache_write_usd_per_mtok AS "Cache-write $/Mtok", effective_date AS "As of", pricing_source AS "Source"
    FROM ({_B8}) x"""))
def q_rename_project(spark, sf):
    return rp.display_pricing(rp.report_pricing_reference(_mart(spark, sf, "dim_token_pricing")))


# ================================================================== F: filters

_LEGACY_KEEP = "NOT coalesce(retriever IN ('graph_neighborhood'), FALSE)"
_HAIKU = "generator_model_family = 'claude-haiku-4-5'"


@reg("exclude_legacy", O(f"SELECT scored_answer_sk, retriever FROM af WHERE {_LEGACY_KEEP}"))
def q_exclude_legacy(spark, sf):
    return rp.exclude_legacy(_af(spark, sf)).select("scored_answer_sk", "retriever")


@reg("fixed_generator", O(f"SELECT scored_answer_sk, generator_model_family FROM af WHERE {_HAIKU}"))
def q_fixed_generator(spark, sf):
    return rp.fixed_generator(_af(spark, sf)).select("scored_answer_sk", "generator_model_family")


@reg("sparql_only", O(f"SELECT scored_answer_sk, writer_model FROM af WHERE {_HAIKU} AND retriever = 'graph_sparqlgen'"))
def q_sparql_only(spark, sf):
    return rp.sparql_only(_af(spark, sf)).select("scored_answer_sk", "writer_model")


_F4 = f"{_HAIKU} AND {_LEGACY_KEEP} AND (writer_model IS NULL OR starts_with(writer_model, 'claude-haiku-4-5'))"


@reg("harness_slice", O(f"SELECT scored_answer_sk, harness_version, writer_model FROM af WHERE {_F4}"))
def q_harness_slice(spark, sf):
    return rp.harness_slice(_af(spark, sf)).select("scored_answer_sk", "harness_version", "writer_model")


@reg("not_null_filter", O("SELECT scoring FROM dim_scoring"))
def q_not_null_filter(spark, sf):
    e = _enriched(spark, sf)
    return e.select("scoring").where(F.col("scoring").isNotNull()).distinct()


@reg("dropna_subset", O(f"SELECT display_label, cost_per_correct FROM ({_B3_FULL}) x WHERE cost_per_correct IS NOT NULL",
                        ("cost_per_correct",)))
def q_dropna_subset(spark, sf):
    r = rp.report_cost_per_correct(_af(spark, sf))
    return r.dropna(subset=["cost_per_correct"]).select("display_label", "cost_per_correct")


_CELLS_ALL = """SELECT display_label, type_id, type_display_label, sort_order, CAST(count(*) AS BIGINT) AS total,
        CAST(sum(passed) AS BIGINT) AS passed, avg(total_tokens) AS avg_tokens, sum(passed) / count(*) AS accuracy
    FROM af WHERE display_label IS NOT NULL AND type_id IS NOT NULL AND type_display_label IS NOT NULL
      AND sort_order IS NOT NULL
    GROUP BY display_label, type_id, type_display_label, sort_order"""


@reg("group_dropna", O(_CELLS_ALL, ("avg_tokens", "accuracy")))
def q_group_dropna(spark, sf):
    return agg.pass_rates(_af(spark, sf), rp.RETRIEVER_BY_TYPE)


# ================================================================== J: joins

@reg("join_alias", O("SELECT portkey_model_key, model_resolved FROM catalog"))
def q_join_alias(spark, sf):
    return _pipe(spark, sf).stg_pricing().select("portkey_model_key", "model_resolved")


@reg("join_traversal", O("SELECT run_id, question_id, retriever, mechanism, writer_model FROM sa"))
def q_join_traversal(spark, sf):
    raw = _pipe(spark, sf).raw("scored_answer")
    a = st.stg_scored_answers(raw).select("run_id", "question_id", "retriever")
    t = st.stg_traversal(raw).select("run_id", "question_id", "mechanism", "writer_model")
    return join_traversal(a, t)


@reg("join_questions", O("SELECT run_id, question_id, type_id, template_id, question_hop_count FROM enriched"))
def q_join_questions(spark, sf):
    return _pipe(spark, sf).enriched().select("run_id", "question_id", "type_id", "template_id", "question_hop_count")


@reg("join_runs", O("""SELECT run_id, question_id, run_ts, judge_model, corpus_build_id, harness_version
    FROM enriched"""))
def q_join_runs(spark, sf):
    return _pipe(spark, sf).enriched().select(
        "run_id", "question_id", "run_ts", "judge_model", "corpus_build_id", "harness_version")


@reg("join_generator_price", O("SELECT run_id, question_id, generator_pricing_sk, generator_cost_usd FROM enriched"))
def q_join_gen_price(spark, sf):
    return _pipe(spark, sf).enriched().select("run_id", "question_id", "generator_pricing_sk", "generator_cost_usd")


@reg("join_writer_price", O("SELECT run_id, question_id, writer_pricing_sk, writer_cost_usd FROM enriched"))
def q_join_writer_price(spark, sf):
    return _pipe(spark, sf).enriched().select("run_id", "question_id", "writer_pricing_sk", "writer_cost_usd")


@reg("join_retriever_labels", O("SELECT * FROM dim_retriever_cond"))
def q_join_retriever_labels(spark, sf):
    return mt.dim_retriever_cond(_enriched(spark, sf), seed(spark, "seed_retriever_labels"))


@reg("join_scoring_labels", O("SELECT * FROM dim_scoring"))
def q_join_scoring_labels(spark, sf):
    return mt.dim_scoring(_enriched(spark, sf), seed(spark, "seed_scoring_labels"))


@reg("join_type_labels", O("SELECT question_id, type_id, type_family, type_display_label FROM dim_question"))
def q_join_type_labels(spark, sf):
    d = mt.dim_question(_pipe(spark, sf).questions(), seed(spark, "seed_question_type_labels"))
    return d.select("question_id", "type_id", "type_family", "type_display_label")


@reg("join_corpus_profile", O("""SELECT corpus_sk, corpus_build_id, corpus_scale, corpus_sha, triple_count,
    paper_count, corpus_measured_at FROM dim_corpus"""))
def q_join_corpus_profile(spark, sf):
    p = _pipe(spark, sf)
    return mt.dim_corpus(p.runs(), p.profiles()).select(
        "corpus_sk", "corpus_build_id", "corpus_scale", "corpus_sha", "triple_count", "paper_count",
        "corpus_measured_at")


@reg("override_anti_join", O("""
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)"""))
def q_override_anti_join(spark, sf):
    c = _table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    over = _table(spark, sf, "supplier").where(F.col("s_acctbal") < 0).select("s_nationkey")
    return null_aware_anti_join(c, over, "c_nationkey", "s_nationkey")


@reg("lateral_object_explode", O("SELECT provider, portkey_model_key FROM catalog"))
def q_lateral_object_explode(spark, sf):
    return st.explode_catalog(_pipe(spark, sf).raw("model_pricing")).select("provider", "portkey_model_key")


_GT_ELEMS = """
    SELECT question_id, 1 AS ord, 'a-' || CAST(eid AS varchar) AS elem FROM questions WHERE k % 5 = 1
    UNION ALL SELECT question_id, 2, 'b-' || CAST(eid AS varchar) FROM questions WHERE k % 5 = 1
    UNION ALL SELECT question_id, 1, '' FROM questions WHERE k % 5 = 3
    UNION ALL SELECT question_id, 2, NULL FROM questions WHERE k % 5 = 3
    UNION ALL SELECT question_id, 3, 'c-' || CAST(eid AS varchar) FROM questions WHERE k % 5 = 3
    UNION ALL SELECT question_id, 1, NULL FROM questions WHERE k % 5 = 4"""


def _gt_elements(spark, sf):
    raw = _pipe(spark, sf).raw("question")
    arr = F.try_variant_get(parsed("payload"), "$.ground_truth", "array<string>")
    return raw.select("question_id", F.posexplode(arr).alias("pos", "elem")).select(
        "question_id", (F.col("pos") + 1).alias("ord"), "elem")


@reg("lateral_array_elements", O(_GT_ELEMS))
def q_lateral_array_elements(spark, sf):
    return _gt_elements(spark, sf)


@reg("star_join", O("""SELECT scored_answer_sk, type_id, display_label, generator_model_family, writer_model_family,
    harness_version FROM af"""))
def q_star_join(spark, sf):
    return _af(spark, sf).select("scored_answer_sk", "type_id", "display_label", "generator_model_family",
                                 "writer_model_family", "harness_version")


@reg("fk_orphan_join", O("""SELECT scored_answer_sk, scoring_sk FROM fct
    WHERE scoring_sk NOT IN (SELECT scoring_sk FROM dim_scoring)"""))
def q_fk_orphan(spark, sf):
    f = _mart(spark, sf, "fct_scored_answer").select("scored_answer_sk", "scoring_sk")
    return orphans(f, "scoring_sk", _mart(spark, sf, "dim_scoring"), "scoring_sk")


@reg("question_coverage", O("SELECT run_id, question_id FROM sa WHERE question_id NOT IN (SELECT question_id FROM questions)"))
def q_question_coverage(spark, sf):
    a = _pipe(spark, sf).raw("scored_answer").select("run_id", "question_id")
    bank = _pipe(spark, sf).raw("question").select("question_id")
    return a.join(bank, "question_id", "left_anti").select("run_id", "question_id")


# ================================================================== A: aggregations

@reg("distinct_conditions", O("SELECT DISTINCT retriever, mechanism, neighborhood_hops, top_k FROM enriched"))
def q_distinct_conditions(spark, sf):
    return _enriched(spark, sf).select(*mt.RETRIEVER_KEY).distinct()


@reg("distinct_generators", O("""SELECT DISTINCT generator_provider, generator_model_id, generator_model_family,
    generator_temperature FROM enriched"""))
def q_distinct_generators(spark, sf):
    return _enriched(spark, sf).select("generator_provider", "generator_model_id", "generator_model_family",
                                       "generator_temperature").distinct()


@reg("distinct_writers", O("SELECT DISTINCT writer_model, writer_model_family, writer_temperature FROM enriched"))
def q_distinct_writers(spark, sf):
    return _enriched(spark, sf).select("writer_model", "writer_model_family", "writer_temperature").distinct()


@reg("distinct_scoring", O("SELECT DISTINCT scoring FROM enriched"))
def q_distinct_scoring(spark, sf):
    return _enriched(spark, sf).select("scoring").distinct()


@reg("ordered_string_agg", O(f"""SELECT question_id, string_agg(elem, ', ' ORDER BY ord) AS answer_text
    FROM ({_GT_ELEMS}) e GROUP BY question_id HAVING count(elem) > 0"""))
def q_ordered_string_agg(spark, sf):
    e = _gt_elements(spark, sf)
    s = F.expr("listagg(elem, ', ') WITHIN GROUP (ORDER BY ord)")
    return e.groupBy("question_id").agg(s.alias("answer_text"), F.count("elem").alias("_n")).where(
        F.col("_n") > 0).drop("_n")


@reg("accuracy_cells", O(_CELLS_ALL, ("avg_tokens", "accuracy")))
def q_accuracy_cells(spark, sf):
    return agg.pass_rates(_af(spark, sf), rp.RETRIEVER_BY_TYPE)


_A7 = """SELECT CAST(count(*) AS BIGINT) AS scored, coalesce(avg(passed), 0.0) AS pass_rate,
        CAST(coalesce(sum(passed), 0) AS BIGINT) AS num_correct, coalesce(sum(coalesce(total_cost_d, 0.0)), 0.0) AS total_cost
    FROM af"""
_A7_FULL = f"""SELECT *, CASE WHEN num_correct > 0 THEN total_cost / num_correct END AS cost_per_correct FROM ({_A7}) k"""
_A8 = f"""SELECT coalesce(min(display_label) FILTER (WHERE accuracy = (SELECT max(accuracy) FROM per)), '—') AS best_label,
        max(accuracy) AS best_accuracy FROM per"""
_A8_WITH = f"""SELECT * FROM (WITH per AS (SELECT display_label, sum(passed) / count(*) AS accuracy FROM af
        WHERE {_LEGACY_KEEP} AND display_label IS NOT NULL GROUP BY display_label) {_A8}) b"""


@reg("headline_kpis", O(_A7_FULL, ("pass_rate", "total_cost", "cost_per_correct")))
def q_headline_kpis(spark, sf):
    return rp.headline_kpis(_af(spark, sf))


@reg("best_retriever", O(_A8_WITH, ("best_accuracy",)))
def q_best_retriever(spark, sf):
    return rp.best_retriever(_af(spark, sf))


@reg("cost_per_correct", O(_B3_FULL, _B3_D))
def q_cost_per_correct(spark, sf):
    return rp.report_cost_per_correct(_af(spark, sf))


_A10 = """SELECT display_label, sort_order, avg(retrieval_latency_ms) AS Retrieval,
        avg(generation_latency_ms) AS Generation, CAST(count(*) AS BIGINT) AS n
    FROM af WHERE display_label IS NOT NULL AND sort_order IS NOT NULL GROUP BY display_label, sort_order"""


@reg("latency_split", O(_A10, ("Retrieval", "Generation")))
def q_latency_split(spark, sf):
    return rp.latency_split(_af(spark, sf))


@reg("questions_per_type", O("SELECT type_id, CAST(count(*) AS BIGINT) AS n_questions FROM dim_question GROUP BY type_id"))
def q_questions_per_type(spark, sf):
    return agg.group_sizes(_mart(spark, sf, "dim_question"), "type_id", "n_questions")


@reg("distinct_sorted_list", O(f"""SELECT coalesce(string_agg(DISTINCT writer_model, ', ' ORDER BY writer_model), '—')
    AS writer_model_list FROM af WHERE {_HAIKU} AND {_LEGACY_KEEP}"""))
def q_distinct_sorted_list(spark, sf):
    return rp.writers_pooled(_af(spark, sf))


@reg("row_counts", O("""
    SELECT 'run_manifest' AS relation, CAST(count(*) AS BIGINT) AS n_rows FROM runs
    UNION ALL SELECT 'scored_answer', count(*) FROM sa
    UNION ALL SELECT 'question', count(*) FROM questions
    UNION ALL SELECT 'corpus_profile', count(*) FROM profiles
    UNION ALL SELECT 'model_pricing', count(DISTINCT provider) FROM catalog"""))
def q_row_counts(spark, sf):
    p = _pipe(spark, sf)
    out = None
    for t in ld.RAW_TABLES:
        c = agg.row_counts(p.raw(t), t)
        out = c if out is None else out.unionByName(c)
    return out


@reg("duplicate_groups", O("""SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1"""))
def q_duplicate_groups(spark, sf):
    return ld.duplicate_keys(_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@reg("version_count", O(f"SELECT CAST(count(DISTINCT harness_version) AS BIGINT) AS version_count FROM af WHERE {_F4}"))
def q_version_count(spark, sf):
    return rp.harness_versions(_af(spark, sf))


# ================================================================== W: window-like

@reg("first_example_per_type", O("""SELECT type_id, min(question_id) AS question_id,
    arg_min(question_text, question_id) AS question_text FROM dim_question GROUP BY type_id"""))
def q_first_example(spark, sf):
    return agg.first_row_per_group(_mart(spark, sf, "dim_question"), "type_id", "question_id", ["question_text"])


@reg("newest_batch_per_run", O(f"SELECT run_id, '{NEW}' AS batch FROM runs"))
def q_newest_batch(spark, sf):
    return lf.dedupe_run_batches(lf.scan_manifests(spark, _landing(spark, sf))).select("run_id", "batch")


@reg("ordinality", O("SELECT run_id, question_id, line_no FROM sa"))
def q_ordinality(spark, sf):
    return _pipe(spark, sf).raw("scored_answer").select("run_id", "question_id", "line_no")


# ================================================================== O / U / R: order, limits, sets, reshape

def _placed(df):
    """A bounded frame with each row's place in the order that it has (compared as a value)."""
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return df.withColumn("place", place.cast("bigint"))


def _place(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) AS place"


@reg("canonical_axis_order", O(f"""SELECT *, {_place('sort_order NULLS LAST, display_label NULLS LAST')}
    FROM (SELECT DISTINCT display_label, sort_order FROM af) x"""))
def q_canonical_axis(spark, sf):
    axis = agg.ordered(_af(spark, sf).select("display_label", "sort_order").distinct(), "sort_order", "display_label")
    return _placed(axis)


@reg("question_type_axis", O(f"""SELECT *, {_place('rank, type_display_label')} FROM (
    SELECT DISTINCT type_id, type_display_label, CAST(dense_rank() OVER (ORDER BY type_id) AS INTEGER) AS rank
    FROM af WHERE type_id IS NOT NULL) x"""))
def q_question_type_axis(spark, sf):
    return _placed(rp.question_type_axis(_af(spark, sf)))


@reg("sort_by_sort_order", O(f"SELECT display_label, sort_order, {_place('sort_order')} FROM ({_B3_FULL}) x"))
def q_sort_by_sort_order(spark, sf):
    return _placed(rp.report_cost_per_correct(_af(spark, sf)).select("display_label", "sort_order"))


@reg("pricing_reference_sort", O(f"SELECT *, {_place('provider, model_resolved')} FROM ({_B8}) x", _B8_D))
def q_pricing_reference_sort(spark, sf):
    return row_positions(rp.report_pricing_reference(_mart(spark, sf, "dim_token_pricing")))


@reg("sorted_ids", O("SELECT run_id FROM runs ORDER BY run_id"))
def q_sorted_ids(spark, sf):
    return _pipe(spark, sf).raw("run_manifest").select("run_id").orderBy("run_id")


@reg("preview_limit", O("""SELECT scored_answer_sk, run_sk, score, total_cost_usd FROM fct
    ORDER BY scored_answer_sk LIMIT 100"""))
def q_preview_limit(spark, sf):
    from ..plans.analyses import previews

    p = previews(_pipe(spark, sf), adapter.marts_root(spark, sf))["fct_scored_answer"]
    return p.select("scored_answer_sk", "run_sk", "score", "total_cost_usd")


_O6_COLS = ["retriever", "mechanism", "neighborhood_hops", "top_k", "generator_provider", "generator_model_family",
            "writer_model_family", "harness_version"]


@reg("condition_combinations", O(
    f"SELECT DISTINCT {', '.join(_O6_COLS)} FROM enriched ORDER BY "
    + ", ".join(f"{c} NULLS LAST" for c in _O6_COLS) + " LIMIT 1000"))
def q_condition_combinations(spark, sf):
    from ..plans.analyses import condition_combinations

    return condition_combinations(_enriched(spark, sf))


@reg("union_distinct", O("SELECT corpus_build_id FROM runs UNION SELECT corpus_build_id FROM profiles"))
def q_union_distinct(spark, sf):
    p = _pipe(spark, sf)
    return mt.observed_corpora(p.runs(), p.profiles())


@reg("union_all_override", O("SELECT model_resolved, provider, pricing_source FROM pricing"))
def q_union_all_override(spark, sf):
    return _pipe(spark, sf).pricing().select("model_resolved", "provider", "pricing_source")


@reg("unpivot_phases", O(_B6, ("avg_latency_ms",)))
def q_unpivot_phases(spark, sf):
    return rp.report_latency_split(_af(spark, sf))


# ================================================================== Q: data quality

def _mart_tables(spark, sf) -> dict[str, DataFrame]:
    return {n: _mart(spark, sf, n) for n in mt.MARTS}


_FK = [("run_sk", "dim_run"), ("question_sk", "dim_question"), ("generator_sk", "dim_generator"),
       ("retriever_cond_sk", "dim_retriever_cond"), ("writer_sk", "dim_writer"), ("scoring_sk", "dim_scoring"),
       ("corpus_sk", "dim_corpus")]
_NOT_NULL = [("dim_run", "run_sk"), ("dim_run", "run_id"), ("dim_question", "question_sk"),
             ("dim_question", "question_id"), ("dim_generator", "generator_sk"),
             ("dim_retriever_cond", "retriever_cond_sk"), ("dim_writer", "writer_sk"), ("dim_scoring", "scoring_sk"),
             ("dim_scoring", "scoring"), ("dim_corpus", "corpus_sk"), ("dim_token_pricing", "pricing_sk"),
             ("dim_token_pricing", "model_resolved"), ("fct_scored_answer", "scored_answer_sk")]
_UNIQUE = [("fct_scored_answer", "scored_answer_sk"), ("dim_run", "run_sk"), ("dim_run", "run_id"),
           ("dim_question", "question_sk"), ("dim_question", "question_id"), ("dim_generator", "generator_sk"),
           ("dim_retriever_cond", "retriever_cond_sk"), ("dim_writer", "writer_sk"), ("dim_scoring", "scoring_sk"),
           ("dim_scoring", "scoring"), ("dim_corpus", "corpus_sk"), ("dim_corpus", "corpus_build_id"),
           ("dim_token_pricing", "pricing_sk"), ("dim_token_pricing", "model_resolved")]
# Accepted value lists of the declared tests.
_ACCEPTED = [
    ("dim_generator", "generator_provider", ("anthropic", "ollama")),
    ("dim_retriever_cond", "mechanism", ("dense", "neighborhood", "sparqlgen", "none")),
    ("dim_retriever_cond", "retriever", ("closed_book", "vector", "graph_neighborhood", "graph_neighborhood_1hop",
                                         "graph_neighborhood_2hop", "graph_sparqlgen")),
    ("dim_scoring", "scoring", ("string_match", "set_match", "numerical", "binary", "boolean", "semantic")),
    ("dim_token_pricing", "rate_unit", ("usd_per_mtok",)),
    ("dim_token_pricing", "pricing_source", ("portkey", "override")),
]
_ORACLE_REL = {"fct_scored_answer": "fct"}


def _orel(r):
    return _ORACLE_REL.get(r, r)


def _oracle_checks(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


@reg("dq_not_null", O(_oracle_checks([
    f"SELECT 'not_null' AS \"check\", '{r}' AS relation, '{c}' AS \"column\", "
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {_orel(r)}" for r, c in _NOT_NULL])))
def q_dq_not_null(spark, sf):
    return dq.run_checks(_mart_tables(spark, sf), [dq.Check("not_null", r, c) for r, c in _NOT_NULL])


@reg("dq_unique", O(_oracle_checks([
    f"SELECT 'unique' AS \"check\", '{r}' AS relation, '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS failures "
    f"FROM (SELECT {c} FROM {_orel(r)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x"
    for r, c in _UNIQUE] + [
    "SELECT 'unique', 'lineitem', 'l_orderkey|l_linenumber', CAST(count(*) AS BIGINT) FROM (SELECT l_orderkey, "
    "l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) x"])))
def q_dq_unique(spark, sf):
    t = _mart_tables(spark, sf)
    t["lineitem"] = _table(spark, sf, "lineitem")
    checks = [dq.Check("unique", r, c) for r, c in _UNIQUE] + [dq.Check("unique", "lineitem", "l_orderkey|l_linenumber")]
    return dq.run_checks(t, checks)


def _in(vals):
    return ", ".join(f"'{v}'" for v in vals)


@reg("dq_accepted_values", O(_oracle_checks([
    f"SELECT 'accepted_values' AS \"check\", '{r}' AS relation, '{c}' AS \"column\", "
    f"CAST(count(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({_in(v)})) AS BIGINT) AS failures "
    f"FROM {_orel(r)}" for r, c, v in _ACCEPTED])))
def q_dq_accepted(spark, sf):
    return dq.run_checks(_mart_tables(spark, sf), [dq.Check("accepted_values", r, c, values=v) for r, c, v in _ACCEPTED])


@reg("dq_relationships", O(_oracle_checks([
    f"SELECT 'relationships' AS \"check\", 'fct_scored_answer' AS relation, '{c}' AS \"column\", "
    f"CAST(count(*) AS BIGINT) AS failures FROM fct WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {p})"
    for c, p in _FK] + [
    f"SELECT 'relationships', 'fct_scored_answer', '{c}', CAST(count(*) AS BIGINT) FROM fct "
    f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT pricing_sk FROM dim_token_pricing)"
    for c in ("generator_pricing_sk", "writer_pricing_sk")])))
def q_dq_relationships(spark, sf):
    checks = [dq.Check("relationships", "fct_scored_answer", c, parent=p, parent_column=c) for c, p in _FK]
    checks += [dq.Check("relationships", "fct_scored_answer", c, parent="dim_token_pricing", parent_column="pricing_sk")
               for c in ("generator_pricing_sk", "writer_pricing_sk")]
    return dq.run_checks(_mart_tables(spark, sf), checks)


@reg("dq_contract", O("""SELECT 35 AS n_columns, 0 AS n_mismatches,
    CAST(count(*) FILTER (WHERE scored_answer_sk IS NULL) AS BIGINT) AS null_keys FROM fct"""))
def q_dq_contract(spark, sf):
    f = _mart(spark, sf, "fct_scored_answer", doubles=False)
    return dq.contract_report(f, mt.FACT_CONTRACT, "scored_answer_sk")


_NOW = dt.datetime(2024, 2, 3, 0, 0, 0)


@reg("dq_freshness", O(f"""SELECT 'events' AS relation, max(ts) AS max_loaded_at,
    (epoch(TIMESTAMP '{_NOW:%Y-%m-%d %H:%M:%S}') - epoch(max(ts))) / 3600.0 AS age_hours,
    CASE WHEN (epoch(TIMESTAMP '{_NOW:%Y-%m-%d %H:%M:%S}') - epoch(max(ts))) / 3600.0 > 168 THEN 'error'
         WHEN (epoch(TIMESTAMP '{_NOW:%Y-%m-%d %H:%M:%S}') - epoch(max(ts))) / 3600.0 > 48 THEN 'warn'
         ELSE 'pass' END AS status FROM events""", ("age_hours",)))
def q_dq_freshness(spark, sf):
    return dq.freshness(_table(spark, sf, "events"), "ts", _NOW, relation="events")


@reg("dq_price_shape", O("""SELECT provider, CAST(count(*) AS BIGINT) AS n_models,
    CAST(count(*) AS BIGINT) AS n_with_request_price, TRUE AS ok FROM catalog GROUP BY provider"""))
def q_dq_price_shape(spark, sf):
    from ..operators.pricing_snapshot import catalog_shape

    raw = _pipe(spark, sf).raw("model_pricing")
    return catalog_shape(raw.select("provider", F.to_json(jsub(parsed("payload"), "models")).alias("models_json")))


@reg("dq_idempotent_load", O("""
    SELECT 'runs' AS count_name, CAST(count(*) AS BIGINT) AS first_pass, CAST(count(*) AS BIGINT) AS second_pass FROM runs
    UNION ALL SELECT 'records', count(*), count(*) FROM sa
    UNION ALL SELECT 'questions', count(*), count(*) FROM questions
    UNION ALL SELECT 'corpus_profiles', count(*), count(*) FROM profiles
    UNION ALL SELECT 'pricing_snapshots', count(DISTINCT provider), count(DISTINCT provider) FROM catalog"""))
def q_dq_idempotent(spark, sf):
    """Q8: land the same tree twice into a fresh raw folder; both passes report equal counts."""
    import uuid

    from ..session import workspace_dir

    root = _landing(spark, sf)
    raw = f"{workspace_dir(spark)}/idempotency/{uuid.uuid4().hex}"
    first = ld.land_all(spark, root, raw)
    second = ld.land_all(spark, root, raw)
    rows = [(k, int(first[k]), int(second[k])) for k in first]
    return spark.createDataFrame(rows, "count_name string, first_pass bigint, second_pass bigint")


@reg("dq_grain_keys", O("""SELECT CAST(count(*) AS BIGINT) AS n_records,
    CAST(count(*) FILTER (WHERE question_id IS NULL OR retriever IS NULL) AS BIGINT) AS failures FROM sa"""))
def q_dq_grain_keys(spark, sf):
    return dq.grain_keys(st.stg_scored_answers(_pipe(spark, sf).raw("scored_answer")))


@reg("dq_mechanism_derivable", O("""SELECT CAST(count(*) AS BIGINT) AS n_records,
    CAST(count(*) FILTER (WHERE mechanism IS NULL OR mechanism NOT IN ('dense', 'neighborhood', 'sparqlgen', 'none'))
         AS BIGINT) AS failures FROM sa"""))
def q_dq_mechanism(spark, sf):
    return dq.mechanism_derivable(st.stg_traversal(_pipe(spark, sf).raw("scored_answer")))


@reg("dq_filename_key", O("""SELECT 'run_manifest' AS relation, CAST(count(*) FILTER (WHERE run_id IS NULL) AS BIGINT)
    AS failures FROM runs
    UNION ALL SELECT 'corpus_profile', CAST(count(*) FILTER (WHERE corpus_build_id IS NULL) AS BIGINT) FROM profiles"""))
def q_dq_filename_key(spark, sf):
    root = _landing(spark, sf)
    m = dq.filename_key(lf.scan_manifests(spark, root), "run_id", "run_id", "run_manifest")
    c = dq.filename_key(lf.scan_corpus_profiles(spark, root), "corpus_build_id", "corpus_build_id", "corpus_profile")
    return m.unionByName(c)


# ================================================================== M: pipeline relations

_RUN_COLS = ["run_id", "run_ts", "retriever", "generator_provider", "generator_model", "generator_model_resolved",
             "generator_temperature", "judge_model", "corpus_build_id", "harness_version", "num_questions",
             "generator_system_prompt_sha256"]
_ANS_COLS = ["run_id", "question_id", "retriever", "scoring", "generator_provider", "generator_model",
             "generator_model_resolved", "generator_model_id", "generator_model_family", "generator_temperature",
             "score", "is_passed", "is_judged", "verdict", "error", "generator_input_tokens",
             "generator_output_tokens", "generator_cache_read_tokens", "generator_cache_creation_tokens",
             "context_tokens_proxy", "num_sources", "retrieval_latency_ms", "generation_latency_ms"]
_ANS_D = ("generator_temperature", "score", "retrieval_latency_ms", "generation_latency_ms")
_TRAV_COLS = ["run_id", "question_id", "mechanism", "neighborhood_hops", "neighborhood_num_triples",
              "neighborhood_num_linked", "top_k", "dense_num_chunks", "embed_model", "writer_model",
              "writer_model_family", "writer_temperature", "writer_input_tokens", "writer_output_tokens",
              "is_sparql_valid", "sparql_num_rows", "endpoint", "context_tokenizer"]
_Q_COLS = ["question_id", "type_id", "template_id", "scoring", "answer_var", "question_text",
           "ground_truth_answer_text", "question_hop_count", "num_seed_entities"]
_PROF_COLS = ["corpus_build_id", "corpus_scale", "corpus_measured_at", "triple_count", "node_count", "edge_count",
              "ttl_bytes", "ttl_sha256", "paper_count", "chunk_count", "word_count", "chunk_size", "chunk_overlap",
              "store_bytes", "embed_model"]
_STG_PRICE_COLS = ["provider", "model_resolved", "portkey_model_key", "input_usd_per_mtok", "output_usd_per_mtok",
                   "cache_read_usd_per_mtok", "cache_write_usd_per_mtok", "effective_date", "source_note"]
_ENR_COLS = [
    "run_id", "question_id", "run_ts", "judge_model", "corpus_build_id", "harness_version",
    "generator_system_prompt_sha256", "generator_provider", "generator_model_id", "generator_model_family",
    "generator_temperature", "retriever", "mechanism", "writer_model", "writer_model_family", "embed_model",
    "endpoint", "scoring", "type_id", "template_id", "question_hop_count", "num_seed_entities", "score",
    "is_passed", "is_judged", "verdict", "error", "is_error", "generator_input_tokens", "generator_output_tokens",
    "generator_cache_read_tokens", "generator_cache_creation_tokens", "generator_total_tokens",
    "context_tokens_proxy", "num_sources", "retrieval_latency_ms", "generation_latency_ms", "total_latency_ms",
    "neighborhood_hops", "neighborhood_num_triples", "neighborhood_num_linked", "top_k", "dense_num_chunks",
    "writer_temperature", "writer_input_tokens", "writer_output_tokens", "writer_total_tokens", "is_sparql_valid",
    "sparql_num_rows", "generator_pricing_sk", "writer_pricing_sk", "generator_cost_usd", "writer_cost_usd"]
_ENR_D = ("generator_temperature", "score", "retrieval_latency_ms", "generation_latency_ms", "total_latency_ms",
          "writer_temperature")


def _sel(cols, rel):
    return f"SELECT {', '.join(cols)} FROM {rel}"


@reg("stg_runs", O(_sel(_RUN_COLS, "runs"), ("generator_temperature",)))
def q_stg_runs(spark, sf):
    return _pipe(spark, sf).runs().select(*_RUN_COLS)


@reg("stg_scored_answers", O(_sel(_ANS_COLS, "sa"), _ANS_D))
def q_stg_scored_answers(spark, sf):
    return st.stg_scored_answers(_pipe(spark, sf).raw("scored_answer")).select(*_ANS_COLS)


@reg("stg_traversal", O(_sel(_TRAV_COLS, "sa"), ("writer_temperature",)))
def q_stg_traversal(spark, sf):
    return st.stg_traversal(_pipe(spark, sf).raw("scored_answer")).select(*_TRAV_COLS)


@reg("stg_questions", O(_sel(_Q_COLS, "questions")))
def q_stg_questions(spark, sf):
    return _pipe(spark, sf).questions().select(*_Q_COLS)


@reg("stg_corpus_profile", O(_sel(_PROF_COLS, "profiles")))
def q_stg_corpus_profile(spark, sf):
    return _pipe(spark, sf).profiles().select(*_PROF_COLS)


@reg("stg_model_pricing", O(_sel(_STG_PRICE_COLS, "catalog")))
def q_stg_model_pricing(spark, sf):
    return _pipe(spark, sf).stg_pricing().select(*_STG_PRICE_COLS)


@reg("int_model_pricing", O("SELECT * FROM pricing"))
def q_int_model_pricing(spark, sf):
    return _pipe(spark, sf).pricing()


@reg("int_scored_answers_enriched", O(_sel(_ENR_COLS, "enriched"), _ENR_D))
def q_int_enriched(spark, sf):
    return _pipe(spark, sf).enriched().select(*_ENR_COLS)


@reg("dim_run", O("SELECT * FROM dim_run"))
def q_dim_run(spark, sf):
    return mt.dim_run(_pipe(spark, sf).runs())


@reg("dim_question", O("SELECT * FROM dim_question"))
def q_dim_question(spark, sf):
    return mt.dim_question(_pipe(spark, sf).questions(), seed(spark, "seed_question_type_labels"))


@reg("dim_retriever_cond", O("SELECT * FROM dim_retriever_cond"))
def q_dim_retriever_cond(spark, sf):
    return mt.dim_retriever_cond(_pipe(spark, sf).enriched(), seed(spark, "seed_retriever_labels"))


@reg("dim_generator", O("SELECT * FROM dim_generator", ("generator_temperature",)))
def q_dim_generator(spark, sf):
    return mt.dim_generator(_pipe(spark, sf).enriched())


@reg("dim_writer", O("SELECT * FROM dim_writer", ("writer_temperature",)))
def q_dim_writer(spark, sf):
    return mt.dim_writer(_pipe(spark, sf).enriched())


@reg("dim_scoring", O("SELECT * FROM dim_scoring"))
def q_dim_scoring(spark, sf):
    return mt.dim_scoring(_pipe(spark, sf).enriched(), seed(spark, "seed_scoring_labels"))


@reg("dim_corpus", O("SELECT * FROM dim_corpus"))
def q_dim_corpus(spark, sf):
    p = _pipe(spark, sf)
    return mt.dim_corpus(p.runs(), p.profiles())


@reg("dim_token_pricing", O("SELECT * FROM dim_token_pricing"))
def q_dim_token_pricing(spark, sf):
    return mt.dim_token_pricing(_pipe(spark, sf).pricing())


@reg("fct_scored_answer", O("SELECT * FROM fct", ("score", "retrieval_latency_ms", "generation_latency_ms",
                                                  "total_latency_ms")))
def q_fct(spark, sf):
    return mt.fct_scored_answer(_pipe(spark, sf).enriched())


# ================================================================== O5: whole rows of the previews

# relation of each preview: its rows in the oracle, the total order, its columns (none: all) and doubles
_PREVIEWS = {
    "raw_run_manifest": ("runs", ["run_id"], ["run_id"], ()), "raw_scored_answer": ("sa", ["run_id", "question_id"], ["run_id", "question_id", "line_no"], ()),
    "raw_question": ("questions", ["question_id"], ["question_id"], ()),
    "stg_runs": ("runs", ["run_id"], _RUN_COLS, ("generator_temperature",)), "stg_scored_answers": ("sa", ["run_id", "question_id"], _ANS_COLS, _ANS_D),
    "stg_traversal": ("sa", ["run_id", "question_id"], _TRAV_COLS, ("writer_temperature",)), "stg_questions": ("questions", ["question_id"], _Q_COLS, ()),
    "int_scored_answers_enriched": ("enriched", ["run_id", "question_id"], _ENR_COLS, _ENR_D),
    "dim_run": ("dim_run", ["run_sk"], [], ()), "dim_question": ("dim_question", ["question_sk"], [], ()),
    "dim_retriever_cond": ("dim_retriever_cond", ["retriever_cond_sk"], [], ()), "dim_generator": ("dim_generator", ["generator_sk"], [], ("generator_temperature",)),
    "dim_writer": ("dim_writer", ["writer_sk"], [], ("writer_temperature",)), "dim_scoring": ("dim_scoring", ["scoring_sk"], [], ()),
    "dim_corpus": ("dim_corpus", ["corpus_sk"], [], ()), "dim_token_pricing": ("dim_token_pricing", ["pricing_sk"], [], ()),
}


def _reg_preview(name: str, rows: str, keys: list[str], columns: list[str], doubles: tuple[str, ...]) -> None:
    order = ", ".join(keys)

    @reg(f"preview_{name}", O(f"SELECT {', '.join(columns) or '*'}, {_place(order)} FROM {rows} ORDER BY {order} LIMIT 100", doubles))
    def q_preview(spark, sf):
        from ..plans.analyses import previews

        found = previews(_pipe(spark, sf), adapter.marts_root(spark, sf))[name]
        return _placed(found.select(*columns) if columns else found)


for _name, _spec in _PREVIEWS.items():
    _reg_preview(_name, *_spec)


# ================================================================== cases that fail, or that the seeds leave empty

_ODD = "('1', '3', '5', '7', '9')"


@reg("raw_pk_guard_repeats", O(f"SELECT run_id, question_id, CAST(2 AS BIGINT) AS n_rows FROM sa WHERE right(run_id, 1) IN {_ODD}"))
def q_pk_guard_repeats(spark, sf):
    """K6 on answers of which those of some runs are there twice."""
    answers = _pipe(spark, sf).raw("scored_answer").select("run_id", "question_id")
    return ld.duplicate_keys(answers.unionByName(answers.where(f"right(run_id, 1) IN {_ODD}")), ["run_id", "question_id"])


@reg("dq_contract_broken", O("""SELECT 35 AS n_columns, 1 AS n_mismatches, CAST(count(*) FILTER (WHERE score IS NULL) AS BIGINT) AS null_keys FROM fct"""))
def q_dq_contract_broken(spark, sf):
    """Q5 on a fact with a column of another type, and with rows without key."""
    f = _mart(spark, sf, "fct_scored_answer", doubles=False)
    f = f.withColumn("total_cost_usd", F.col("total_cost_usd").cast("double")).withColumn("scored_answer_sk", F.when(F.col("score").isNotNull(), F.col("scored_answer_sk")))
    return dq.contract_report(f, mt.FACT_CONTRACT, "scored_answer_sk")


@reg("dq_price_shape_broken", O("""SELECT provider, CAST(CASE WHEN ascii(right(provider, 1)) % 4 < 2 THEN 0 ELSE count(*) END AS BIGINT) AS n_models,
    CAST(CASE WHEN ascii(right(provider, 1)) % 4 < 3 THEN 0 ELSE count(*) END AS BIGINT) AS n_with_request_price, ascii(right(provider, 1)) % 4 = 3 AS ok
    FROM catalog GROUP BY provider"""))
def q_dq_price_shape_broken(spark, sf):
    """Q7 on catalogs of which some are empty, no object, or without the request price."""
    from ..operators.pricing_snapshot import catalog_shape

    raw = _pipe(spark, sf).raw("model_pricing").select("provider", F.to_json(jsub(parsed("payload"), "models")).alias("m"))
    kind = F.expr("ascii(right(provider, 1)) % 4")
    broken = (F.when(kind == 0, F.lit("{}")).when(kind == 1, F.lit("[1]"))
              .when(kind == 2, F.replace("m", F.lit('"request_token"'), F.lit('"request"'))).otherwise(F.col("m")))
    return catalog_shape(raw.select("provider", broken.alias("models_json")))


@reg("dq_filename_key_wrong", O(f"""SELECT 'run_manifest' AS relation, CAST(count(*) AS BIGINT) AS failures FROM runs WHERE right(run_id, 1) IN {_ODD}
    UNION ALL SELECT 'corpus_profile', CAST(count(*) AS BIGINT) FROM profiles WHERE right(corpus_build_id, 1) IN {_ODD}"""))
def q_dq_filename_key_wrong(spark, sf):
    """Q11 on files of which some are named after another key."""
    root = _landing(spark, sf)

    def moved(scan, key):
        return scan.withColumn(key, F.when(F.substring(key, -1, 1).isin(*"13579"), F.concat(key, F.lit("-moved"))).otherwise(F.col(key)))

    m = moved(lf.dedupe_run_batches(lf.scan_manifests(spark, root)), "run_id")
    c = moved(lf.scan_corpus_profiles(spark, root), "corpus_build_id")
    return dq.filename_key(m, "run_id", "run_id", "run_manifest").unionByName(dq.filename_key(c, "corpus_build_id", "corpus_build_id", "corpus_profile"))


@reg("join_alias_crosswalk", O("""SELECT provider, portkey_model_key, CASE WHEN ascii(right(portkey_model_key, 1)) % 2 = 0
    THEN 'resolved-' || portkey_model_key ELSE model_resolved END AS model_resolved FROM catalog"""))
def q_join_alias_crosswalk(spark, sf):
    """J1 with a crosswalk that has an entry for half of the catalog's models."""
    raw = _pipe(spark, sf).raw("model_pricing")
    keys = st.explode_catalog(raw).select("portkey_model_key").distinct().where("ascii(right(portkey_model_key, 1)) % 2 = 0")
    alias = keys.withColumn("model_resolved", F.concat(F.lit("resolved-"), "portkey_model_key"))
    return st.stg_model_pricing(raw, alias).select("provider", "portkey_model_key", "model_resolved")


# ================================================================== B: reports

_B1_COLS = ["scored_answer_sk", "type_id", "type_display_label", "display_label", "retriever", "sort_order",
            "generator_model_family", "writer_model_family", "harness_version", "passed", "total_tokens",
            "total_cost_usd"]


@reg("analysis_frame", O(
    "SELECT " + ", ".join(c for c in _B1_COLS) + " FROM af"))
def q_analysis_frame(spark, sf):
    """B1; the cost measure is compared as the exact decimal it is stored as."""
    a = _af(spark, sf).withColumn("total_cost_usd", F.col("total_cost_usd").cast("decimal(38,12)"))
    return a.select(*_B1_COLS)


@reg("report_headline", O(f"SELECT * FROM ({_A7_FULL}) k, ({_A8_WITH}) b",
                          ("pass_rate", "total_cost", "cost_per_correct", "best_accuracy")))
def q_report_headline(spark, sf):
    return rp.report_headline(_af(spark, sf))


@reg("report_cost_per_correct", O(_B3_FULL, _B3_D))
def q_report_cost_per_correct(spark, sf):
    return rp.report_cost_per_correct(_af(spark, sf))


def _cells(row: str, where: str, with_sort: bool) -> str:
    keys = [row, "type_id", "type_display_label"] + (["sort_order"] if with_sort else [])
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT {', '.join(keys)}, CAST(count(*) AS BIGINT) AS total, CAST(sum(passed) AS BIGINT) AS passed, "
            f"avg(total_tokens) AS avg_tokens, sum(passed) / count(*) AS accuracy FROM af "
            f"WHERE {where} AND {nn} GROUP BY {', '.join(keys)}")


_CD = ("avg_tokens", "accuracy")


@reg("report_accuracy_matrix", O(_cells("display_label", f"{_HAIKU} AND {_LEGACY_KEEP}", True), _CD))
def q_report_accuracy_matrix(spark, sf):
    return rp.report_accuracy_matrix(_af(spark, sf))


@reg("report_writer_matrix", O(_cells("writer_model_family", f"{_HAIKU} AND retriever = 'graph_sparqlgen'", False), _CD))
def q_report_writer_matrix(spark, sf):
    return rp.report_writer_matrix(_af(spark, sf))


@reg("report_latency_split", O(_B6, ("avg_latency_ms",)))
def q_report_latency_split(spark, sf):
    return rp.report_latency_split(_af(spark, sf))


@reg("report_ground_truth", O("""
    SELECT type_id, coalesce(type_display_label, type_id) AS type_display_label,
        coalesce(type_description, '—') AS type_description, n_questions, question_text,
        coalesce(ground_truth_answer_text, '— (unanswerable)') AS ground_truth_answer_text
    FROM (SELECT *, row_number() OVER (PARTITION BY type_id ORDER BY question_id) AS rn,
                 CAST(count(*) OVER (PARTITION BY type_id) AS BIGINT) AS n_questions FROM dim_question) x
    WHERE rn = 1"""))
def q_report_ground_truth(spark, sf):
    return rp.report_ground_truth(_mart(spark, sf, "dim_question"))


@reg("report_pricing_reference", O(f"{_B8} ORDER BY provider, model_resolved", _B8_D))
def q_report_pricing_reference(spark, sf):
    return rp.report_pricing_reference(_mart(spark, sf, "dim_token_pricing"))


@reg("report_token_usage", O(_cells("display_label", f"{_HAIKU} AND {_LEGACY_KEEP}", True), _CD))
def q_report_token_usage(spark, sf):
    return rp.report_token_usage(_af(spark, sf))


@reg("report_harness_evolution", O(_cells("harness_version", _F4, False), _CD))
def q_report_harness_evolution(spark, sf):
    return rp.report_harness_evolution(_af(spark, sf))


@reg("report_writer_series", O(_cells("writer_model_family", f"{_HAIKU} AND retriever = 'graph_sparqlgen'", False), _CD))
def q_report_writer_series(spark, sf):
    return rp.report_writer_series(_af(spark, sf))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparison form: doubles rounded (aggregation order makes the last bits differ)."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`") for f in df.schema.fields
    ])


# ================================================================== Q1-Q4: the whole declared suite

_DECLARED_REL = {
    "raw.run_manifest": "runs", "raw.scored_answer": "sa", "raw.question": "questions",
    "raw.corpus_profile": "profiles", "raw.model_pricing": "(SELECT DISTINCT provider FROM catalog)",
    "stg_runs": "runs", "stg_scored_answers": "sa", "stg_traversal": "sa", "stg_questions": "questions",
    "stg_corpus_profile": "profiles", "stg_model_pricing": "catalog", "int_model_pricing": "pricing",
    "fct_scored_answer": "fct", "seed_pricing_local_overrides": "overrides", "seed_pricing_model_alias": "alias_seed",
    "seed_retriever_labels": "retriever_labels", "seed_scoring_labels": "scoring_labels",
    "seed_question_type_labels": "type_labels",
}


def _declared_oracle() -> str:
    from ..plans.declared_checks import DECLARED

    def rel(r):
        return _DECLARED_REL.get(r, r)

    parts = []
    for ch in DECLARED:
        head = f"SELECT '{ch.kind}' AS \"check\", '{ch.relation}' AS relation, '{ch.column}' AS \"column\", "
        c, src = ch.column, rel(ch.relation)
        if ch.kind == "not_null":
            body = f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {src} _t"
        elif ch.kind == "unique":
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {src} _t WHERE {c} IS NOT NULL "
                    f"GROUP BY {c} HAVING count(*) > 1) _x")
        elif ch.kind == "accepted_values":
            vals = ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in ch.values)
            body = (f"CAST(count(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})) AS BIGINT) "
                    f"AS failures FROM {src} _t")
        else:
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM {src} _t WHERE {c} IS NOT NULL AND {c} NOT IN "
                    f"(SELECT {ch.parent_column} FROM {rel(ch.parent)} WHERE {ch.parent_column} IS NOT NULL)")
        parts.append(head + body)
    return "\nUNION ALL\n".join(parts)


@reg("dq_declared_suite", O(_declared_oracle()))
def q_dq_declared_suite(spark, sf):
    """Q1-Q4: all 86 declared tests (sources, staging, intermediate, marts, seeds) as one tidy frame."""
    from ..plans.declared_checks import run_declared_checks

    return run_declared_checks(spark, adapter.raw_root(spark, sf), adapter.marts_root(spark, sf))
