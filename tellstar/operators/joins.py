"""Join building blocks: size-checked broadcast, null-aware anti join, anti-join orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only behind a measured bound.

    The side is checkpointed (written to the cluster's checkpoint folder, lineage cut,
    never served from a stale cache entry) and counted; below ``max_rows`` it is hinted
    for a broadcast hash join, above it the frame is returned as is and the planner keeps
    a shuffle join (AQE may still convert it at runtime from real statistics)."""
    from ..session import workspace_dir

    workspace_dir(df.sparkSession)  # make sure a checkpoint folder exists (tests: a local one)
    df = df.checkpoint(eager=True)
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def null_aware_anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """SQL ``left_key NOT IN (SELECT right_key FROM right)``.

    Three-valued semantics: a NULL probe value is dropped, and any NULL on the right side
    drops every row. The right side's distinct keys are tested for NULL by one small job, then
    joined by a plain ``left_anti`` whose build side the planner sizes (a null-aware anti join
    would be broadcast whatever its size)."""
    keys = right.select(F.col(right_key).alias("_k")).distinct()
    if keys.where(F.col("_k").isNull()).limit(1).count():
        return left.limit(0)
    known = left.where(F.col(left_key).isNotNull())
    return known.join(keys, known[left_key] == keys["_k"], "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null FK has no parent (J15): a left anti join on the key."""
    parent_keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(parent_keys, fk, "left_anti")

