"""Write one named text file per key (e.g. ``reference/pricing/<provider>.json``).

Rows are dealt to tasks by key and sorted there. Spark names its output files itself, so where only
Spark can reach the folder, rows are written partitioned by the key and each part file is then moved
to its contract name with a Hadoop FileSystem rename (a metadata operation). That takes several file
system calls per file on one machine, so many small files in a folder that every executor has mounted
(a ``file:`` URI, shared like the checkpoint folder) are written by the tasks under their names."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fs

#: Spark's name for a partition whose key is null or empty.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
Named = Callable[[dict[str, str]], str]


def write_named_text(df: DataFrame, parts: list[str], staging: str, dest_for: Named, order: str | None = None,
                     value: Column | None = None) -> int:
    """``df`` has the key columns ``parts``, a ``value`` column and optionally ``order``. A ``value``
    that is given is made of the other columns once the rows are dealt: long texts made of a few
    numbers are not shuffled and sorted."""
    spark = df.sparkSession
    (
        _dealt(df, parts, order, value)
        .write.mode("overwrite")
        .partitionBy(*parts)
        .text(staging)
    )
    moves = []
    for f in fs.files_below(spark, staging, "part-*"):
        segs = f.rstrip("/").split("/")
        vals = {}
        for seg in segs:
            if "=" in seg:
                k, v = seg.split("=", 1)
                vals[k] = unquote(v)
        if set(vals) != set(parts):
            continue
        moves.append((f, dest_for(vals)))
    fs.renames(spark, moves)
    fs.delete(spark, staging)
    return len(moves)


def write_named_documents(df: DataFrame, parts: list[str], staging: str, dest_for: Named, order: str | None = None) -> int:
    """``write_named_text`` for many small files: the same files, written by the tasks themselves
    where the folder is one that they have mounted."""
    probe = urlparse(staging)
    if probe.scheme != "file" or probe.netloc:
        return write_named_text(df, parts, staging, dest_for, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, n = None, None, 0
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    key = {p: NO_NAME if row[p] in (None, "") else str(row[p]) for p in parts}
                    if key != now:
                        if out is not None:
                            out.finish()
                        now, out, n = key, _File(urlparse(dest_for(key)).path), n + 1
                    out.line(row["value"])
            if out is not None:
                out.finish()
        except BaseException:
            if out is not None:
                out.drop()
            raise
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return sum(r.n for r in _dealt(df, parts, order).mapInArrow(run, "n long").collect())


def _dealt(df: DataFrame, parts: list[str], order: str | None, value: Column | None = None) -> DataFrame:
    sort_cols = [*parts, order] if order else list(parts)
    text = F.col("value") if value is None else value.alias("value")
    return df.repartition(*parts).sortWithinPartitions(*sort_cols).select(*parts, text)


class _File:
    """A text file that gets its name once it is whole (a task that is run twice replaces it)."""

    def __init__(self, path: str):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        self.path, self.draft = path, f"{os.path.dirname(path)}/.draft-{uuid.uuid4().hex}"
        self.out = open(self.draft, "w", encoding="utf-8", newline="")

    def line(self, value: str | None) -> None:
        self.out.write((value or "") + "\n")

    def finish(self) -> None:
        self.out.close()
        os.replace(self.draft, self.path)

    def drop(self) -> None:
        self.out.close()
        if os.path.exists(self.draft):
            os.unlink(self.draft)
