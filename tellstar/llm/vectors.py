"""Helpers for operators on vectors: rows that take part, whole-number components, sums of tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .topk import matrices

#: Components beyond this are held to it (no sum of products of two of them leaves the doubles).
MOST = 2.0 ** 500
#: Doubles of one block of a summed table.
BLOCK = 1 << 12


def finite(vector: Column) -> Column:
    """True where the vector and all its components are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def doubles(vectors: DataFrame, *keep: Column) -> DataFrame:
    """(kept columns, v array<double>) of the rows whose vector is there and finite throughout."""
    parts = vectors.select(*keep, F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return parts.where(finite(F.col("v")))


def floors(frame: DataFrame, scale: int) -> DataFrame:
    """``frame`` with floor(scale * x) for each component of ``v``, as doubles within +-MOST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            bounds = np.asarray(column.offsets).astype(np.int64)
            values = column.values.to_numpy()[bounds[0]:bounds[-1]]
            with np.errstate(over="ignore"):
                numbers = np.clip(np.floor(scale * values), -MOST, MOST)
            new = pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), pa.array(numbers))
            yield pa.RecordBatch.from_pydict({n: new if n == "v" else batch.column(n) for n in batch.schema.names})

    return frame.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in frame.dtypes))


def tiles(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Some ``rows`` rows together: their other columns, and by dimension the rows' places and
    their vectors ``v`` as a matrix."""
    held: list[pa.RecordBatch] = []

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        column = table.column("v").chunk(0) if table.column("v").num_chunks else table.column("v").combine_chunks()
        return table, {dim: (at, m) for dim, at, m in matrices(np.arange(len(table)), column)}

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield out()
            held.clear()
    if held:
        yield out()


def summed(parts: DataFrame, tables) -> dict[int, np.ndarray]:
    """By key the sum of all tasks' tables of one shape. ``tables(batches)`` gives a task's tables
    by key; they are cut in blocks of BLOCK doubles, and Spark adds up each block in task order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for key, table in tables(batches).items():
            flat = np.ascontiguousarray(table, np.float64).ravel()
            blocks = [flat[lo:lo + BLOCK].tobytes() for lo in range(0, len(flat), BLOCK)]
            for lo in range(0, len(blocks), 64):
                some = blocks[lo:lo + 64]
                yield pa.RecordBatch.from_pydict({"key": pa.array([key] * len(some), pa.int32()), "block": pa.array(range(lo, lo + len(some)), pa.int32()),
                                                  "task": pa.array([task] * len(some), pa.int32()), "data": pa.array(some, pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, b, d.as_buffer()) for batch in batches for k, b, d in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), batch.column("data")))
        for (key, block), same in groupby(rows, lambda r: r[:2]):
            total = 0.0
            for _, _, data in same:
                total = total + np.frombuffer(data, np.float64)
            yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int32()), "block": pa.array([block], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    dealt = parts.mapInArrow(cut, "key int, block int, task int, data binary").repartition("key", "block").sortWithinPartitions("key", "block", "task")
    found: dict[int, dict[int, bytes]] = {}
    for r in dealt.mapInArrow(add, "key int, block int, data binary").collect():
        found.setdefault(r.key, {})[r.block] = bytes(r.data)
    return {key: np.frombuffer(b"".join(blocks[b] for b in sorted(blocks)), np.float64) for key, blocks in found.items()}
