"""Incremental landing driven by Structured Streaming (K1 on arrival).

The original loader re-lands every run on a daily schedule. Here a file-source stream over the
landing root picks up manifests as they arrive; each micro-batch lands exactly those runs
(their sibling records files) with the rules of ``land_runs``: documents must be JSON, a run is
replaced whole, and an older batch that arrives late does not replace a newer one. With
``on_missing_records="skip"`` a manifest whose records file is not there yet waits in a pending
table; every later micro-batch, and every start of the stream, tries the waiting ones again.
The stream's checkpoint records which files were processed, so a restarted or
``availableNow`` run continues where it stopped, and a re-delivered batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.landing import land_runs, missing_records, valid_json
from ..sources import landing_files as lf
from ..sources.tables import read_table, table_exists, update_snapshot


def manifest_stream(spark: SparkSession, root: str) -> DataFrame:
    """New ``*.manifest.json`` files below ``root`` (outside ``reference/``) as they appear."""
    df = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" + lf.MANIFEST_SUFFIX)
        .load(root)
        .select(lf.file_uri().alias("source_uri"), F.col("value").alias("payload"))
    )
    rel = lf.relative_uri("source_uri", root)
    return df.withColumn("_rel", rel).where(lf._not_reference(F.col("_rel"))).select(
        lf._stem(F.col("source_uri"), lf.MANIFEST_SUFFIX).alias("run_id"),
        lf.folder_of(F.col("_rel")).alias("batch"),
        "source_uri",
        "payload",
    )


PENDING_COLUMNS = ["run_id", "batch", "source_uri", "payload"]


def pending_path(raw_dir: str) -> str:
    return f"{raw_dir.rstrip('/')}/pending_manifest"


def land_arrived(spark: SparkSession, root: str, raw_dir: str, arrived: DataFrame | None, on_missing_records: str = "raise",
                 buckets: int | None = None) -> None:
    """Land the arrived manifests and those that wait; what has no records file waits (on)."""
    path = pending_path(raw_dir)
    waiting = read_table(spark, path).select(*PENDING_COLUMNS) if table_exists(spark, path) else None
    rows = [r.select(*PENDING_COLUMNS) for r in (arrived, waiting) if r is not None]
    if not rows:
        return
    manifests = valid_json(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]))
    manifests = lf.dedupe_run_batches(manifests).checkpoint(eager=True)
    if not manifests.limit(1).count():
        return
    land_runs(spark, root, raw_dir, on_missing_records=on_missing_records, manifests=manifests, buckets=buckets)
    if on_missing_records == "skip":
        late = missing_records(spark, root, manifests).select("run_id", "batch")
        still = manifests.join(late, ["run_id", "batch"], "left_semi").select(*PENDING_COLUMNS)
        if waiting is not None or still.limit(1).count():
            # what another stream has made wait meanwhile goes on waiting
            tried = manifests.select("run_id", "batch")
            update_snapshot(spark, path, lambda old: still if old is None else old.join(tried, ["run_id", "batch"], "left_anti").select(*PENDING_COLUMNS).unionByName(still))


def start_landing_stream(spark: SparkSession, root: str, raw_dir: str, checkpoint: str,
                         available_now: bool = True, on_missing_records: str = "raise",
                         buckets: int | None = None) -> StreamingQuery:
    """Land runs as their manifests arrive; ``available_now`` drains what exists and stops.
    ``buckets`` selects the hash-bucketed answers layout (see ``land_runs``)."""

    def land_batch(batch: DataFrame, epoch_id: int) -> None:
        land_arrived(spark, root, raw_dir, batch, on_missing_records, buckets)

    if table_exists(spark, pending_path(raw_dir)):
        land_arrived(spark, root, raw_dir, None, on_missing_records, buckets)
    writer = manifest_stream(spark, root).writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
