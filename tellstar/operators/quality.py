"""Declarative data-quality checks (Q1-Q11) returning one tidy result frame.

Each check is a small aggregate over the checked relation (counts only; failing rows are
never collected), and ``run_checks`` unions them into
``(check, relation, column, failures)`` rows, so a whole test suite is one job.
Failure counts follow the usual semantics of these tests:

* not_null        rows where the column is NULL
* unique          key values (non-NULL) that occur more than once
* accepted_values distinct non-NULL values outside the accepted list
* relationships   child rows with a non-NULL key that has no parent row
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | accepted_values | relationships
    relation: str
    column: str
    values: tuple = ()             # accepted values
    parent: str | None = None      # relationships: parent relation
    parent_column: str | None = None
    args: dict = field(default_factory=dict)




def not_null(df: DataFrame, c: str) -> DataFrame:
    """Q1."""
    return df.agg(F.count(F.when(F.col(c).isNull(), 1)).alias("failures"))


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q2 (A14): number of non-NULL key values that repeat."""
    k = df.select(*cols).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
    return k.groupBy(*cols).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("failures"))


def accepted_values(df: DataFrame, c: str, values: tuple) -> DataFrame:
    """Q3: distinct non-NULL values outside ``values``."""
    bad = df.select(c).where(F.col(c).isNotNull() & ~F.col(c).isin(list(values))).distinct()
    return bad.agg(F.count(F.lit(1)).alias("failures"))


def relationships(child: DataFrame, c: str, parent: DataFrame, pc: str) -> DataFrame:
    """Q4 (J15): child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(pc).alias(c)).distinct()
    return child.select(c).where(F.col(c).isNotNull()).join(keys, c, "left_anti").agg(
        F.count(F.lit(1)).alias("failures")
    )


def _key_text(cols: list[str]) -> Column:
    """One text key per row (composite keys joined); NULL when any component is NULL."""
    parts = [F.col(c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    any_null = None
    for c in cols:
        n = F.col(c).isNull()
        any_null = n if any_null is None else (any_null | n)
    return F.when(~any_null, F.concat_ws("\u0001", *parts))


def _watched(ch: Check) -> Column:
    """The key text that a row of the checked relation brings into the count (NULL: none)."""
    c = F.col(ch.column) if ch.kind != "unique" else None
    if ch.kind == "not_null":
        return F.when(c.isNull(), F.lit(""))
    if ch.kind == "accepted_values":
        return F.when(~c.isin(list(ch.values)), c.cast("string"))
    if ch.kind == "relationships":
        return c.cast("string")
    if ch.kind == "unique":
        return _key_text(ch.column.split("|"))
    raise ValueError(ch.kind)


def _with_ids(per_check: DataFrame, checks: list[Check]) -> DataFrame:
    """Attach the check descriptions; a check without failing keys reports 0."""
    spark = per_check.sparkSession
    ids = spark.createDataFrame([(i, c.kind, c.relation, c.column) for i, c in enumerate(checks)],
                                "cid int, check string, relation string, column string")
    return F.broadcast(ids).join(per_check, "cid", "left").select(
        "check", "relation", "column", F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"))


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Evaluate every check: one scan per relation, one shuffle for all of them.

    A relation's rows are turned, in one projection, into (check, key) pairs: the key of a unique
    check, the foreign key or parent key of a relationship, and only for offending rows an
    unaccepted value or a NULL's mark. The pairs of all relations are counted together (partial
    counts before the shuffle, so a hot key or a foreign key with few values is cheap), and the
    failures of each check follow from its keys' counts. Relations backed by the same frame share
    its scan. Keys are grouped by their text, so no hash can report a false duplicate."""
    frames: dict[int, DataFrame] = {}
    brought: dict[int, list[Column]] = {}

    def bring(relation: str, cid: int, key: Column, parent: int) -> None:
        df = tables[relation]
        frames[id(df)] = df
        brought.setdefault(id(df), []).append(F.struct(F.lit(cid).alias("cid"), key.alias("k"), F.lit(parent).alias("parent")))

    for cid, ch in enumerate(checks):
        bring(ch.relation, cid, _watched(ch), 0)
        if ch.kind == "relationships":
            bring(ch.parent, cid, F.col(ch.parent_column).cast("string"), 1)
    pairs = None
    for name, df in frames.items():
        own = df.select(F.inline(F.array(*brought[name]))).where(F.col("k").isNotNull())
        pairs = own if pairs is None else pairs.unionByName(own)
    keys = pairs.groupBy("cid", "k").agg(F.sum(1 - F.col("parent")).alias("n"), F.max("parent").alias("parent"))

    def of(kind: str) -> Column:
        return F.col("cid").isin([i for i, ch in enumerate(checks) if ch.kind == kind])

    failed = (F.when(of("not_null"), F.col("n")).when(of("accepted_values"), F.lit(1))
              .when(of("unique"), (F.col("n") > 1).cast("int")).otherwise(F.when(F.col("parent") == 0, F.col("n")).otherwise(0)))
    return _with_ids(keys.groupBy("cid").agg(F.sum(failed).alias("failures")), checks)


def contract_report(df: DataFrame, contract: T.StructType, key: str) -> DataFrame:
    """Q5 as data: number of contract columns, mismatching columns, NULL keys."""
    got = {f.name: f.dataType for f in df.schema.fields}
    names = [f.name for f in df.schema.fields]
    mismatches = sum(1 for f in contract.fields if got.get(f.name) != f.dataType)
    mismatches += sum(1 for a, b in zip(names, [f.name for f in contract.fields]) if a != b and a in got)
    mismatches += abs(len(names) - len(contract.fields))
    return df.agg(
        F.lit(len(contract.fields)).alias("n_columns"),
        F.lit(mismatches).alias("n_mismatches"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys"),
    )


def freshness(df: DataFrame, loaded_at: str, now: dt.datetime, warn_days: float = 2, error_days: float = 7,
              relation: str = "") -> DataFrame:
    """Q6: age of the newest row against a passed-in ``now``: pass / warn / error."""
    newest = F.max(F.col(loaded_at).cast("timestamp"))
    age_h = (F.lit(now).cast("timestamp").cast("double") - newest.cast("double")) / 3600.0
    status = (
        F.when(age_h > error_days * 24, "error").when(age_h > warn_days * 24, "warn").otherwise("pass")
    )
    return df.agg(
        F.lit(relation).alias("relation"),
        F.max(loaded_at).alias("max_loaded_at"),
        age_h.alias("age_hours"),
        status.alias("status"),
    )


# The traversal mechanisms every record must be attributable to.
MECHANISMS = ("dense", "neighborhood", "sparqlgen", "none")


def grain_keys(answers: DataFrame) -> DataFrame:
    """Q9: every staged answer has its grain keys (question_id) and its condition (retriever)."""
    bad = F.col("question_id").isNull() | F.col("retriever").isNull()
    return answers.agg(F.count(F.lit(1)).alias("n_records"), F.count(F.when(bad, 1)).alias("failures"))


def mechanism_derivable(traversal: DataFrame) -> DataFrame:
    """Q10: the derived mechanism is one of the known four for every record."""
    ok = F.coalesce(F.col("mechanism").isin(*MECHANISMS), F.lit(False))
    return traversal.agg(F.count(F.lit(1)).alias("n_records"), F.count(F.when(~ok, 1)).alias("failures"))


def filename_key(scan: DataFrame, key: str, payload_field: str, relation: str) -> DataFrame:
    """Q11: the key inside each landed document equals the key taken from its file name."""
    from ..functions.jsonx import jtext, parsed

    differs = ~F.col(key).eqNullSafe(jtext(parsed("payload"), payload_field))
    return scan.agg(F.count(F.when(differs, 1)).alias("failures")).select(F.lit(relation).alias("relation"), "failures")
