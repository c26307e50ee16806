"""Position of a record within its file, computed without funnelling a file into one task.

A splittable text scan hands each task whole byte ranges (``file_block_start``) of files.
Inside one range the rows arrive in file order, so ``monotonically_increasing_id``
(partition id << 33 | row index) is contiguous there. The position of a row is

    rows in earlier ranges of the same file  +  (id - first id of its range)

The text is read once: rows are written with their range and id, and what is counted later, and
joined to them when they are read, are the written values. So ranges need not be the same in any
two reads. The first term comes from a per-range count (one row per range, i.e. per
``maxPartitionBytes`` of input) and a running sum over ranges of a file. Only that small table is
windowed and joined; a hot file never lands in a single task.

``row_positions`` numbers the rows of an ordered frame in the same way, by its partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import workspace_dir

#: The row id of a scan, as it is written.
LINE_ID = "line_id"


def with_line_id(df: DataFrame) -> DataFrame:
    """Rows of a text scan (blank lines already dropped) with their id in it. Write them before
    anything else is done with the ids."""
    return df.withColumn(LINE_ID, F.monotonically_increasing_id())


def range_offsets(written: DataFrame, file_col: str, block_col: str) -> DataFrame:
    """(file, range, first_id, lines_before) of rows written with their id: one row per range."""
    ranges = written.groupBy(file_col, block_col).agg(F.count(F.lit(1)).alias("_n"), F.min(LINE_ID).alias("first_id"))
    before = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("lines_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")


def with_line_number(written: DataFrame, offsets: DataFrame, keys: list[str], out_col: str = "line_no") -> DataFrame:
    """Rows written with their id, and their 0-based position in the file. Where the position is
    not used, the planner drops the join (``offsets`` is grouped by its keys)."""
    one = offsets.groupBy(*keys).agg(F.max("first_id").alias("_first"), F.max("lines_before").alias("_before"))
    place = (F.col("_before") + F.col(LINE_ID) - F.col("_first")).cast("int")
    return written.join(one, keys, "left").withColumn(out_col, place).drop("_first", "_before", LINE_ID)


def _staged(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{workspace_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def line_numbers(df: DataFrame, file_col: str, block_col: str, out_col: str = "line_no") -> DataFrame:
    """Append a 0-based ``out_col`` to rows of a text scan (blank lines already dropped), which is
    run once into the shared scratch folder."""
    written = _staged(with_line_id(df), "lines")
    return with_line_number(written, range_offsets(written, file_col, block_col), [file_col, block_col], out_col)


def row_positions(df: DataFrame, out_col: str = "place") -> DataFrame:
    """The rows of an ordered frame with their place (from 1) in its order.

    A sorted frame's partitions are ranges one after the other. Its rows are written with their
    partition and index, and the rows of the partitions before are added (one row per partition
    is windowed), so no task gets more than its own range."""
    written = _staged(with_line_id(df).withColumn("_part", F.shiftright(LINE_ID, 33)), "ordered")
    counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min(LINE_ID).alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.col("_before") + F.col(LINE_ID) - F.col("_first") + 1
    return written.join(offsets, "_part").withColumn(out_col, place.cast("bigint")).select(*df.columns, out_col)
