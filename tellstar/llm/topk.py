"""Exact top-k search: tiles of queries times tiles of vectors, merged lists per query.

The queries are taken in blocks of a bounded number of bytes. A block is broadcast; each task
multiplies it, tile by tile, with its shard of the vectors, selects every tile's best entries
and merges them into one running list per query. The shards' lists are then merged by query.
No pair of vectors is ever a row, and a task holds two tiles and one block's lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import written
from .text import each_in

#: Rows of a tile of queries or of vectors.
TILE = 1024
#: Components are held to +-LARGEST when they are scaled.
LARGEST = float(np.finfo(np.float64).max)
#: Bytes of query vectors in one block (held by the driver and by every task).
BLOCK_BYTES = 8 << 20


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v array<double>): floor(scale * x) of each component as double; vectors that are
    null or hold a null or non-finite component are left out."""
    parts = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    parts = parts.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    fine = parts.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, values = _lists(batch.column("v"))
            with np.errstate(over="ignore"):
                numbers = np.clip(np.floor(scale * values), -LARGEST, LARGEST)
            new = pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), pa.array(numbers))
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "v": new})

    return fine.mapInArrow(floors, "vec_id long, v array<double>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the lists, and the values they point into from the first bound on."""
    bounds = np.asarray(column.offsets).astype(np.int64)
    return bounds, column.values.to_numpy()[bounds[0]:bounds[-1]]


def matrices(ids: np.ndarray, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, rows) of a list column."""
    bounds, values = _lists(column)
    dims, bounds = np.diff(bounds), bounds - bounds[0]
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, ids[rows], values[each_in(bounds[rows], dims[rows])].reshape(len(rows), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, exact: in doubles where no sum can leave 2**53, else in
    64-bit integers, else in Python's (held to the range of a long)."""
    with np.errstate(over="ignore"):
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0 ** 62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b.tolist()] for p in a.tolist()]
    return np.array([[min(max(x, -(1 << 63)), (1 << 63) - 1) for x in row] for row in exact], np.int64).reshape(len(a), len(b))


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's k highest scores, ties to smaller ids, in order."""
    order = np.lexsort((ids, ~score, query))  # ~x falls as x rises, for every 64-bit x
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def selected(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the entries of a tile that reach their row's k-th highest score;
    ``own`` flags a query's own row, which takes no part."""
    rows, columns = scores.shape
    if columns <= k:
        return np.nonzero(~own)
    held = np.where(own, np.iinfo(np.int64).min, scores)
    least = np.partition(held, columns - k, axis=1)[:, columns - k]
    return np.nonzero((held >= least[:, None]) & ~own)


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k vectors with the highest integer inner
    product to each query, ties to smaller vec_id; all other vectors if there are fewer.

    A query's own vec_id is no candidate, and only vectors of its dimension are. Vectors that
    are null, without id, or hold a null or non-finite component take no part. Rows that repeat
    a vec_id count each as a candidate; the first of them (by value) is the query."""
    numbers = whole_numbers(vectors.select("vec_id", "embedding"), scale)
    asked = written(numbers.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "topk-queries")
    size = asked.agg(F.sum(8 * F.size("v") + 8)).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    found = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        queries = [(dim, ids, m) for batch in rows.to_batches() for dim, ids, m in matrices(batch.column("vec_id").to_numpy(), batch.column("v"))]
        lists = merged(_block(numbers, queries, k), k)
        found.append(written(lists, "topk-lists") if blocks > 1 else lists)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _block(numbers: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(query_id, vec_id, score): every shard's k best for each query of the block."""
    shared = numbers.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {i: [np.empty(0, np.int64)] * 3 for i in range(len(shared.value))}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for dim, others, vectors in matrices(ids, batch.column("v")):
                for i, (d, asked, rows) in enumerate(shared.value):
                    if d != dim:
                        continue
                    for lo in range(0, len(others), TILE):
                        for at in range(0, len(asked), TILE):
                            mine, other = asked[at:at + TILE], others[lo:lo + TILE]
                            scores = products(rows[at:at + TILE], vectors[lo:lo + TILE])
                            row, column = selected(scores, mine[:, None] == other[None, :], k)
                            joined = [np.concatenate(x) for x in zip(lists[i], (mine[row], other[column], scores[row, column]))]
                            top = best(*joined, k)
                            lists[i] = [x[top] for x in joined]
        for columns in lists.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    return numbers.mapInArrow(run, "query_id long, vec_id long, score long")


def merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of all partial lists of each query (Spark keeps k per query in every task
    before it deals the rows out, and merges those)."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
