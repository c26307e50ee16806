"""Land landing files into raw tables (K1-K9): whole JSON documents plus typed keys.

Raw layout under ``raw_dir``::

    run_manifest/      versioned snapshot, one row per run_id; ``landing_pass`` names the pass
                       whose answers are the run's
    scored_answer/     landing_pass=<id>/ parquet files, one folder per pass; a row has its place
                       in the part of the file that one task read
    answer_split/      landing_pass=<id>/ the lines before each such part, which make line_no
    question/          versioned snapshot (full refresh)
    corpus_profile/    versioned snapshot (upsert by corpus_build_id)
    model_pricing/     versioned snapshot (upsert by provider)

Everything is set-based: all runs of a pass are scanned, parsed and written by one job, into a
folder that no manifest names yet. The commit of the next manifest snapshot (one rename, see
``sources/tables.py``) makes the manifests and the answers of the pass visible together; until
then, and if anything fails before it, readers see the old rows. If another writer commits first,
the snapshot is merged again with that writer's rows. Nothing that may be committed is deleted:
a pass removes its own folder only when its commit has certainly not taken effect, and rows of
replaced runs stay in their old pass folders, unseen, until ``vacuum_answers`` removes folders
that no kept manifest version names. The driver makes no call per run.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonx import stext, strict_struct
from ..sources import fs
from ..sources import landing_files as lf
from ..sources.tables import KEEP_SECONDS, CommitUnknown, best_effort, read_table, snapshot_path, table_exists, update_snapshot, versions
from ..session import compiled_methods, workspace_dir
from .joins import broadcast_if_small
from .ordinality import LINE_ID, range_offsets, with_line_id, with_line_number

log = logging.getLogger(__name__)

#: Lines of each part of a records file and of the parts before it (small, one row a part).
SPLITS = "answer_split"
SPLIT_KEYS = ["run_id", "landing_pass", "split_start"]
SPLIT_SCHEMA = "run_id string, split_start bigint, first_id bigint, lines_before bigint"

RAW_TABLES = ("run_manifest", "scored_answer", "question", "corpus_profile", "model_pricing")

SCORED_ANSWER_SCHEMA = T.StructType([
    T.StructField("question_id", T.StringType()),
    T.StructField("line_no", T.IntegerType()),
    T.StructField("source_uri", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("payload", T.StringType()),
    T.StructField("run_id", T.StringType()),
])


#: As a pass writes them: the line number is added on read.
WRITTEN_ANSWER_SCHEMA = T.StructType([
    T.StructField("question_id", T.StringType()),
    T.StructField("split_start", T.LongType()),
    T.StructField(LINE_ID, T.LongType()),
    *[f for f in SCORED_ANSWER_SCHEMA.fields if f.name not in ("question_id", "line_no")],
])


class LoadError(RuntimeError):
    """A landing pass was refused (duplicate key, missing records file, NULL key)."""


def raw_path(raw_dir: str, table: str) -> str:
    return f"{raw_dir.rstrip('/')}/{table}"


PASS_COL = "landing_pass"
#: Lines of one run that stay together when a pass deals its rows to files.
LINES_TOGETHER = 100_000


def read_raw(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """A raw table's live rows. Answers are live if the newest manifest snapshot names their pass
    for their run (a semi join with one narrow row per run, whose side the planner sizes)."""
    path = raw_path(raw_dir, table)
    if table == "run_manifest":
        return read_table(spark, path).drop(PASS_COL)
    if table != "scored_answer":
        return read_table(spark, path)
    schema = T.StructType([*WRITTEN_ANSWER_SCHEMA.fields, T.StructField(PASS_COL, T.StringType())])
    if not table_exists(spark, raw_path(raw_dir, "run_manifest")):
        return spark.createDataFrame([], SCORED_ANSWER_SCHEMA)
    live = read_table(spark, raw_path(raw_dir, "run_manifest")).select("run_id", PASS_COL)
    rows = spark.read.schema(schema).parquet(path).join(live, ["run_id", PASS_COL], "left_semi")
    splits = spark.read.schema(f"{SPLIT_SCHEMA}, {PASS_COL} string").parquet(raw_path(raw_dir, SPLITS))
    return with_line_number(rows, splits, SPLIT_KEYS).select(*SCORED_ANSWER_SCHEMA.fieldNames())


def vacuum_answers(spark: SparkSession, raw_dir: str, older_than: float = KEEP_SECONDS) -> int:
    """Deletes the folders of passes that no kept manifest version names; returns how many. A pass has
    no name before its pass commits, so only folders of ``older_than`` seconds go (0: when no
    landing pass is running)."""
    mpath = raw_path(raw_dir, "run_manifest")
    folders = [c for t in ("scored_answer", SPLITS) for c in fs.list_dir(spark, raw_path(raw_dir, t))
               if f"{PASS_COL}=" in c and fs.age_seconds(spark, c) >= older_than]
    named: set[str] = set()
    for entry in versions(spark, mpath):
        named |= {r[0] for r in spark.read.parquet(snapshot_path(mpath, entry)).select(PASS_COL).distinct().collect()}
    old = [c for c in folders if c.rstrip("/").rsplit("=", 1)[1] not in named]
    for folder in old:
        fs.delete(spark, folder)
    return len({c.rstrip("/").rsplit("=", 1)[1] for c in old})


def _question_id(payload: str):
    """The record's question_id; a line that is not valid JSON fails the pass (FAILFAST),
    like a loader that parses each line before inserting it."""
    return stext(strict_struct(payload, "question_id: string"), "question_id")


def valid_json(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows unchanged, but a document that is not valid JSON fails the job (FAILFAST), as a
    loader that parses each file before storing it would. Kept as a filter so the
    optimizer cannot prune the parse away."""
    return df.where(strict_struct(payload, "_unused: string").isNotNull())


# ---------------------------------------------------------------- guards (K6, K9)

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations present more than once, with their count.

    A first aggregate over a 64-bit hash of the key finds candidate hashes (the shuffle
    carries 8-byte hashes, not key strings); the exact grouping then runs only over the
    rows whose hash repeats (broadcast by AQE from the suspects' runtime size)."""
    narrow = df.select(*keys).withColumn("_h", F.xxhash64(*keys))
    suspects = narrow.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("_h")
    exact = narrow.join(suspects, "_h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return exact.where(F.col("n_rows") > 1)


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def key_violations(df: DataFrame, keys: list[str], limit: int = 10) -> list[tuple]:
    """Up to ``limit`` key values that repeat or contain a NULL (exact).

    The full pass shuffles only a 64-bit hash of the key plus two counters per distinct
    hash (partial aggregation first), not the key strings. Hash values seen more than once
    are then re-checked exactly on the original keys, so a hash collision can never report
    a false duplicate; the exact pass touches only those candidate rows."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else (any_null | c)
    narrow = df.select(*keys).withColumn("_h", F.xxhash64(*keys)).withColumn("_null", any_null.cast("int"))
    per_hash = narrow.groupBy("_h").agg(F.count(F.lit(1)).alias("n"), F.max("_null").alias("has_null"))
    # the suspects are a shuffle stage's output: AQE sees their real size and broadcasts
    # them when small (the usual case), else keeps a shuffle join
    suspects = per_hash.where((F.col("n") > 1) | (F.col("has_null") == 1)).select("_h")
    exact = narrow.join(suspects, "_h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return [tuple(r) for r in exact.where((F.col("n_rows") > 1) | any_null).limit(limit).collect()]


def pk_guard(keys: list[str], table: str):
    """Validation callback: the written rows must satisfy PRIMARY KEY (keys)."""

    def check(written: DataFrame) -> None:
        bad = key_violations(written, keys)
        if bad:
            raise LoadError(f"{table}: primary key {keys} violated (duplicate or NULL): {bad}")

    return check


def missing_records(spark: SparkSession, root: str, manifests: DataFrame | None = None) -> DataFrame:
    """K9: winning manifests whose sibling ``<run_id>.jsonl`` does not exist.

    File presence comes from a content-free ``binaryFile`` listing. That leaves out files without
    any byte, which count as present (they land zero answers): for manifests that it does not
    show, the names of all files in their folders are looked up."""
    if manifests is None:
        manifests = lf.dedupe_run_batches(valid_json(lf.scan_manifests(spark, root)))
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*" + lf.RECORDS_SUFFIX)
    runs = lf.run_folders(spark, root)
    files = reader.option("recursiveFileLookup", "true").load(runs).select("path") if runs else spark.createDataFrame([], "path string")
    gone = manifests.join(_present(files, root), ["run_id", "batch"], "left_anti").select("run_id", "batch", "source_uri")
    folders = [r.batch for r in gone.select("batch").distinct().collect()]
    if not folders:
        return gone
    listed = fs.file_names(reader.load([f"{root.rstrip('/')}/{fs.glob_escaped(b)}" if b else root for b in folders]))
    return gone.join(_present(listed.select(lf.decoded("path").alias("path")), root), ["run_id", "batch"], "left_anti")


def _present(files: DataFrame, root: str) -> DataFrame:
    """(run_id, batch) of records files; ``binaryFile`` paths are plain characters already."""
    return files.select(lf._stem(F.col("path"), lf.RECORDS_SUFFIX).alias("run_id"), lf.folder_of(lf.relative_uri("path", root)).alias("batch")).distinct()


# ---------------------------------------------------------------- runs (K1)

def incoming_runs(spark: SparkSession, root: str, manifests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifests, records) of this pass: one manifest per run (newest batch) and the
    records of its sibling file with their place in the scan (``operators/ordinality.py``);
    records carry the manifest's URI as provenance.

    The winning manifests (one small row per run) are checkpointed: they feed the
    missing-file check, the records join and the manifest snapshot from one scan."""
    workspace_dir(spark)
    if manifests is None:
        manifests = lf.dedupe_run_batches(valid_json(lf.scan_manifests(spark, root))).checkpoint(eager=True)
        lines = lf.record_lines(spark, root)
    else:
        # only the batch folders of the given manifests are read, whole
        manifests = lf.dedupe_run_batches(valid_json(manifests)).checkpoint(eager=True)
        folders = [r.batch for r in manifests.select("batch").distinct().collect()]
        lines = lf.record_lines(spark, root, paths=[f"{root.rstrip('/')}/{b}" if b else root for b in folders])
    winners = broadcast_if_small(
        manifests.select("run_id", "batch", F.col("source_uri").alias("manifest_uri")), max_rows=5_000_000
    )
    # the ids are taken from the scan, before any join or exchange
    records = with_line_id(lines).join(winners, ["run_id", "batch"]).select(
        "run_id",
        _question_id("payload").alias("question_id"),
        "split_start",
        LINE_ID,
        F.col("manifest_uri").alias("source_uri"),
        "payload",
    )
    return manifests, records


def land_runs(
    spark: SparkSession,
    root: str,
    raw_dir: str,
    on_missing_records: str = "raise",
    manifests: DataFrame | None = None,
    buckets: int | None = None,
    incoming: tuple[DataFrame, DataFrame] | None = None,
) -> dict[str, int]:
    """K1: replace every incoming run (manifest + all answers) keyed by run_id.

    Runs absent from this pass keep their rows. A run that now has zero answers loses its old
    ones, as a delete-then-insert would. The new answers go to a folder of this pass and are
    checked there (K6: unique non-null (run_id, question_id), read back column-pruned). Then one
    commit of the manifest snapshot shows manifests and answers together; a refused or failed
    pass leaves all old rows readable and raises. Of two passes at once the later one merges its
    manifests again with the other's; both land.

    ``manifests`` (run_id, batch, source_uri, payload) restricts the pass to those runs
    (incremental landing); by default every run under ``root`` is landed. A run whose landed
    manifest is from a newer batch is left as it is.

    ``buckets`` deals the rows to that many files by run (lines of a very long run to several),
    for many runs that are read one by one; by default each task writes what it has read.
    ``incoming`` is what ``incoming_runs`` has found, for a caller that has looked already.
    Returns the runs and answers that the pass has landed."""
    mpath, answers_dir = raw_path(raw_dir, "run_manifest"), raw_path(raw_dir, "scored_answer")
    compiled_methods(spark)
    manifests, records = incoming or incoming_runs(spark, root, manifests)
    if table_exists(spark, mpath):
        manifests = _not_older(manifests, read_table(spark, mpath), root).checkpoint(eager=True)
        records = records.join(manifests.select("run_id"), "run_id", "left_semi")
    missing = missing_records(spark, root, manifests)
    missing_ids = [r.run_id for r in missing.limit(20).collect()]
    if missing_ids:
        if on_missing_records == "raise":
            raise LoadError(f"records file missing for runs {missing_ids}")
        log.warning("skipping runs without a records file: %s", missing_ids)
        manifests = manifests.join(missing.select("run_id"), "run_id", "left_anti")
        records = records.join(missing.select("run_id"), "run_id", "left_anti")

    now, this_pass = F.current_timestamp(), uuid.uuid4().hex
    folder = f"{answers_dir}/{PASS_COL}={this_pass}"
    splits = f"{raw_path(raw_dir, SPLITS)}/{PASS_COL}={this_pass}"
    rows = records.withColumn("loaded_at", now).select(*WRITTEN_ANSWER_SCHEMA.fieldNames())
    if buckets:
        rows = rows.repartition(buckets, "run_id", F.floor(F.col(LINE_ID) / LINES_TOGETHER))
    landed: dict[str, int] = {}

    def merged(old: DataFrame | None) -> DataFrame:
        """The old manifests (as of this attempt) with those of the pass in their place."""
        own = manifests if old is None else _not_older(manifests, old, root)
        new = own.select("run_id", "source_uri", now.alias("loaded_at"), "payload", F.lit(this_pass).alias(PASS_COL))
        return new if old is None else old.join(new.select("run_id"), "run_id", "left_anti").unionByName(new)

    def checked(written: DataFrame) -> None:
        pk_guard(["run_id"], "run_manifest")(written)
        own = written.where(F.col(PASS_COL) == this_pass)
        landed["runs"] = own.count()
        # as many as were written, unless a newer batch was landed meanwhile
        landed["records"] = staged.join(own.select("run_id"), "run_id", "left_semi").count()

    try:
        rows.write.parquet(folder)
        staged = spark.read.schema(WRITTEN_ANSWER_SCHEMA).parquet(folder)
        pk_guard(["run_id", "question_id"], "scored_answer")(staged)
        range_offsets(staged, "run_id", "split_start").write.parquet(splits)
        update_snapshot(spark, mpath, merged, check=checked)
    except CommitUnknown:
        raise  # a manifest may name the folder
    except Exception:  # the commit has not taken effect; an interrupt leaves the folder to vacuum_answers
        for own in (folder, splits):
            best_effort(fs.delete, spark, own)
        raise
    return landed


def _not_older(manifests: DataFrame, landed: DataFrame, root: str) -> DataFrame:
    """The manifests but those of runs that are landed from a newer batch."""
    known = landed.select("run_id", lf.folder_of(lf.relative_uri("source_uri", root)).alias("_landed"))
    newer = manifests.join(known, "run_id").where(F.col("_landed") > F.col("batch")).select("run_id")
    return manifests.join(newer, "run_id", "left_anti")


# ---------------------------------------------------------------- shared inputs (K2-K4)

def land_questions(spark: SparkSession, root: str, raw_dir: str) -> int:
    """K2: full refresh of the question bank; skipped (table kept) when the bank is absent."""
    if not lf.has_questions(spark, root):
        log.warning("no question bank; skipping question load")
        return 0
    q = lf.scan_questions(spark, root).select(
        _question_id("payload").alias("question_id"),
        F.current_timestamp().alias("loaded_at"),
        "payload",
    )
    rows: list[int] = []

    def checked(written: DataFrame) -> None:
        pk_guard(["question_id"], "question")(written)
        rows.append(written.count())

    update_snapshot(spark, raw_path(raw_dir, "question"), lambda old: q, check=checked)
    return rows[-1]


def upsert(spark: SparkSession, incoming: DataFrame, path: str, key: str, table: str) -> int:
    """K3/K4: incoming rows replace rows with the same key; other rows are kept, those that another
    writer commits meanwhile too (the merge is made again from its rows).

    Incoming documents (one small row per file) are checkpointed first, so the files are
    scanned once for the merge, the write and the returned count."""
    workspace_dir(spark)
    incoming = incoming.checkpoint(eager=True)
    n = incoming.count()

    def merged(old: DataFrame | None) -> DataFrame:
        return incoming if old is None else old.join(incoming.select(key), key, "left_anti").unionByName(incoming)

    update_snapshot(spark, path, merged, check=pk_guard([key], table))
    return n


def land_corpus_profiles(spark: SparkSession, root: str, raw_dir: str) -> int:
    inc = valid_json(lf.scan_corpus_profiles(spark, root)).select(
        "corpus_build_id", "source_uri", F.current_timestamp().alias("loaded_at"), "payload"
    )
    return upsert(spark, inc, raw_path(raw_dir, "corpus_profile"), "corpus_build_id", "corpus_profile")


def land_pricing(spark: SparkSession, root: str, raw_dir: str) -> int:
    inc = valid_json(lf.scan_pricing(spark, root)).select(
        "provider", "source_uri", F.current_timestamp().alias("loaded_at"), "payload"
    )
    return upsert(spark, inc, raw_path(raw_dir, "model_pricing"), "provider", "model_pricing")


def land_all(spark: SparkSession, root: str, raw_dir: str, on_missing_records: str = "raise",
             buckets: int | None = None) -> dict[str, int]:
    """K5: shared inputs first, then every discovered run; returns the pass counts."""
    counts = {"runs": 0, "records": 0, "questions": 0, "corpus_profiles": 0, "pricing_snapshots": 0}
    workspace_dir(spark)
    compiled_methods(spark)
    # the three shared inputs are independent small jobs: submit them together; meanwhile the driver
    # lists the runs, which lands nothing
    with ThreadPoolExecutor(max_workers=4) as pool:
        runs = pool.submit(incoming_runs, spark, root)
        q = pool.submit(land_questions, spark, root, raw_dir)
        c = pool.submit(land_corpus_profiles, spark, root, raw_dir)
        p = pool.submit(land_pricing, spark, root, raw_dir)
        counts["questions"], counts["corpus_profiles"], counts["pricing_snapshots"] = q.result(), c.result(), p.result()
    counts.update(land_runs(spark, root, raw_dir, on_missing_records=on_missing_records, buckets=buckets, incoming=runs.result()))
    return counts
