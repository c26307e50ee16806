"""Fixed folds of documents, table access and written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace_dir


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: the empty text's)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the cluster's shared folder, read back (cuts lineage)."""
    spark = frame.sparkSession
    path = f"{workspace_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
