"""Seed lookups (S8-S12): tiny static tables with pinned schemas.

Bundled CSVs are parsed on the driver and shipped inside the plan (a handful of rows, a
proven size bound), so executors never need to see the package folder. A shared-storage
path can be given instead; then ``spark.read.csv`` with the same explicit schema is used,
which keeps an empty (header-only) seed well typed.
"""

from __future__ import annotations

import csv
import datetime as dt
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_DIR = Path(__file__).parent / "seed_data"

SCHEMAS: dict[str, T.StructType] = {
    "seed_retriever_labels": T.StructType([
        T.StructField("retriever", T.StringType()),
        T.StructField("retriever_family", T.StringType()),
        T.StructField("is_graph", T.BooleanType()),
        T.StructField("display_label", T.StringType()),
        T.StructField("sort_order", T.IntegerType()),
    ]),
    "seed_scoring_labels": T.StructType([
        T.StructField("scoring", T.StringType()),
        T.StructField("scoring_family", T.StringType()),
        T.StructField("display_label", T.StringType()),
    ]),
    "seed_question_type_labels": T.StructType([
        T.StructField("type_id", T.StringType()),
        T.StructField("type_family", T.StringType()),
        T.StructField("display_label", T.StringType()),
        T.StructField("description", T.StringType()),
    ]),
    "seed_pricing_local_overrides": T.StructType([
        T.StructField("provider", T.StringType()),
        T.StructField("model_resolved", T.StringType()),
        T.StructField("input_usd_per_mtok", T.DecimalType(14, 6)),
        T.StructField("output_usd_per_mtok", T.DecimalType(14, 6)),
        T.StructField("cache_read_usd_per_mtok", T.DecimalType(14, 6)),
        T.StructField("cache_write_usd_per_mtok", T.DecimalType(14, 6)),
        T.StructField("effective_date", T.DateType()),
        T.StructField("source_note", T.StringType()),
    ]),
    "seed_pricing_model_alias": T.StructType([
        T.StructField("portkey_model_key", T.StringType()),
        T.StructField("model_resolved", T.StringType()),
    ]),
}


def _convert(value: str, dtype: T.DataType):
    if value == "":
        return None
    if isinstance(dtype, T.BooleanType):
        return value.strip().lower() == "true"
    if isinstance(dtype, T.IntegerType):
        return int(value)
    if isinstance(dtype, T.DecimalType):
        return Decimal(value)
    if isinstance(dtype, T.DateType):
        return dt.date.fromisoformat(value)
    return value


def seed_rows(name: str) -> list[tuple]:
    schema = SCHEMAS[name]
    with open(SEED_DIR / f"{name}.csv", newline="", encoding="utf-8") as fh:
        reader = csv.DictReader(fh)
        return [tuple(_convert(r[f.name], f.dataType) for f in schema.fields) for r in reader]


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """One seed as a DataFrame with its pinned schema."""
    schema = SCHEMAS[name]
    if path is not None:
        return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"')
    return spark.createDataFrame(seed_rows(name), schema=schema)


def seed(spark: SparkSession, name: str) -> DataFrame:
    """Seed marked for broadcast: every seed is a fixed handful of rows."""
    return F.broadcast(read_seed(spark, name))
