"""Deterministic keys and model-name normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original pipeline for keys to line up:
#   null sentinel "∅", component separator "|", md5 hex digest,
#   dated snapshot suffix pattern "-" followed by 8 digits at the end.
NULL_SENTINEL = "∅"
KEY_SEPARATOR = "|"
SNAPSHOT_SUFFIX = r"-\d{8}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the ordered components, each rendered as text with NULL -> sentinel.

    Doubles render through Spark's canonical ``cast(double as string)`` ("0.0"), so a
    temperature hashes the same way in every relation that carries it.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def model_family(c: Column | str) -> Column:
    """Strip a dated snapshot suffix: ``claude-haiku-4-5-20251001`` -> ``claude-haiku-4-5``."""
    return F.regexp_replace(_col(c), SNAPSHOT_SUFFIX, "")
