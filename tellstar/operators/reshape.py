"""Reshaping (R1): wide measure columns to long (name, value) rows, NULLs kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: list[str], values: list[str], var: str, value: str,
            order_col: str | None = None) -> DataFrame:
    """``melt``: one row per (id, value column); NULL measures are kept as rows.

    ``order_col`` optionally numbers the value columns in the given order (0, 1, ...)."""
    long = df.unpivot(ids, values, var, value)
    if order_col:
        m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.lit(i))])
        long = long.withColumn(order_col, m[F.col(var)])
    return long
