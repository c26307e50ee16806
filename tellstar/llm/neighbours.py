"""Approximate nearest neighbours by inner product: a pruned directed graph for each shard.

Vectors are dealt to shards by hash. A task lays a shard's distinct vectors out as a graph:
vectors are inserted in growing batches, a greedy beam search of the graph so far proposes each
one's neighbours, and robust pruning keeps a neighbour only if no kept one is much nearer to it
(by the factor ALPHA), so that few but diverse edges are left; edges back are pruned likewise.
A query walks every shard's graph with a beam, always expanding its nearest vector not expanded
yet. Many searches go step by step together, as numpy arrays.

The largest inner product is the least distance once each vector has one more component that
brings all norms of the graph to the largest one (0 for the query); a shard of very different
norms is split into graphs by norm. Copies of a vector are one node with their ids. The graphs
are a written table, one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import written
from .text import each_in
from .topk import matrices
from .vectors import doubles

#: Vectors of a shard, on average.
SHARD_ROWS = 4096
#: Edges that a pruned node keeps, how many more it may gather before it is pruned again, width
#: of the beam of an insertion, and the least width of a query's beam.
DEGREE, ROOM, BUILD_BEAM, QUERY_BEAM = 32, 1.4, 40, 72
#: A candidate goes when a kept neighbour is nearer to it by this factor than the node is.
ALPHA = 1.2
#: Largest ratio of norms in one graph, and the most graphs that a shard is split into by norm.
BAND, BANDS = 1.3, 16
#: Searches that go together, and the largest share of the graph that one batch may add.
TOGETHER, GROWTH = 512, 0.25
#: Bytes of queries in one block (held by the driver and by every task).
BLOCK_BYTES = 8 << 20


# ---------------------------------------------------------------- graphs

def _distances(points: np.ndarray, norms: np.ndarray, ids: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Squared distance (up to the query's own norm) of each query to its row of node ids; -1: inf."""
    found = norms[ids] - 2 * np.einsum("qd,qrd->qr", asked, points[ids])
    found[ids < 0] = np.inf
    return found


def beam_search(points: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: np.ndarray, asked: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nearest nodes found, in order; nodes expanded) of each query, -1 where there is none.

    Every step expands each query's nearest node in the beam that is not expanded yet."""
    n = len(asked)
    start = np.tile(entry, (n, 1))
    far = _distances(points, norms, start, asked)
    order = np.argsort(far, axis=1, kind="stable")[:, :width]
    beam = np.full((n, width), -1, np.int32)
    dist = np.full((n, width), np.inf, points.dtype)
    beam[:, :order.shape[1]] = np.take_along_axis(start, order, 1)
    dist[:, :order.shape[1]] = np.take_along_axis(far, order, 1)
    done = beam < 0
    paths: list[tuple[np.ndarray, np.ndarray]] = []
    live = np.arange(n)
    while True:
        some = ~done[live].all(axis=1)
        live = live[some]
        if not len(live):
            break
        at = done[live].argmin(axis=1)
        node = beam[live, at]
        done[live, at] = True
        paths.append((live, node))
        near = edges[node]
        known = (near[:, :, None] == beam[live][:, None, :]).any(axis=2)
        near = np.where(known, -1, near)
        all_ids = np.concatenate([beam[live], near], axis=1)
        all_far = np.concatenate([dist[live], _distances(points, norms, near, asked[live])], axis=1)
        all_done = np.concatenate([done[live], near < 0], axis=1)
        best = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_far, best, 1), axis=1, kind="stable"), 1)
        beam[live], dist[live], done[live] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_far, all_done))
        gone = ~np.isfinite(dist[live])
        beam[live] = np.where(gone, -1, beam[live])
        done[live] |= gone
    walked = np.full((n, len(paths)), -1, np.int32)
    for step, (who, node) in enumerate(paths):
        walked[who, step] = node
    return beam, walked


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Up to ``degree`` of each owner's candidates (-1: none): the nearest one stays, those that
    are nearer to it by ``alpha`` than to the owner go, and so on with the nearest left."""
    out = np.full((len(owners), degree), -1, np.int32)
    for lo in range(0, len(owners), 64):
        own, ids = owners[lo:lo + 64], np.sort(candidates[lo:lo + 64], axis=1)
        gone = ids < 0
        gone[:, 1:] |= ids[:, 1:] == ids[:, :-1]
        gone |= ids == own[:, None]
        near = points[ids]
        far = ((near - points[own][:, None, :]) ** 2).sum(axis=2)
        far[gone] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        ids, far, near = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1), np.take_along_axis(near, order[:, :, None], 1)
        norms = (near * near).sum(axis=2)
        apart = norms[:, :, None] + norms[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
        alive, rows = np.isfinite(far), np.arange(len(own))
        for k in range(degree):
            pick = alive.argmax(axis=1)
            good = alive[rows, pick]
            if not good.any():
                break
            out[lo:lo + 64][good, k] = ids[rows, pick][good]
            alive &= alpha * alpha * apart[rows, pick] > far
            alive[rows, pick] = False
    return out


def _with_back_edges(points: np.ndarray, edges: np.ndarray, new: np.ndarray, degree: int) -> None:
    """Adds the edge (neighbour, node) for each edge of the new nodes; a node whose row would
    overflow is pruned to ``degree`` edges."""
    room = edges.shape[1]
    source = np.repeat(new, room)
    target = edges[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    have = (edges[nodes] >= 0).sum(axis=1)
    fits = have + counts <= room
    where = np.repeat(np.arange(len(nodes)), counts)
    rank = np.arange(len(target)) - first[where]
    simple = fits[where]
    edges[target[simple], have[where[simple]] + rank[simple]] = source[simple]
    full = np.flatnonzero(~fits)
    for lo in range(0, len(full), 256):  # of about the same width together
        some = full[np.argsort(counts[full], kind="stable")][lo:lo + 256]
        both = np.full((len(some), room + int(counts[some].max())), -1, np.int32)
        both[:, :room] = edges[nodes[some]]
        picked = each_in(first[some], counts[some])
        both[np.repeat(np.arange(len(some)), counts[some]), room + each_in(np.zeros(len(some), np.int64), counts[some])] = source[picked]
        edges[nodes[some], :degree] = robust_prune(points, nodes[some], both, degree)
        edges[nodes[some], degree:] = -1


def _entries(edges: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """The entry nodes and, as long as walks from them miss a node, one more that they miss."""
    seen = np.zeros(len(edges), bool)
    ahead = entry
    while True:
        seen[ahead] = True
        while len(ahead):
            ahead = np.unique(edges[ahead])
            ahead = ahead[ahead >= 0]
            ahead = ahead[~seen[ahead]]
            seen[ahead] = True
        if seen.all():
            return entry
        ahead = np.array([seen.argmin()], np.int32)
        entry = np.concatenate([entry, ahead])


def build(points: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entry nodes) of the graph over distinct points."""
    n = len(points)
    edges = np.full((n, int(degree * ROOM)), -1, np.int32)
    norms = (points * points).sum(axis=1)
    order = np.random.default_rng(n).permutation(n).astype(np.int32)
    middle = np.array([int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())], np.int32) if n else np.empty(0, np.int32)
    order = np.concatenate([middle, order[~np.isin(order, middle)]])
    first = min(n, 2 * degree)
    edges[order[:first], :degree] = robust_prune(points, order[:first], np.tile(order[:first], (first, 1)), degree)
    at = first
    while at < n:
        new = order[at:at + max(1, min(int(at * GROWTH), TOGETHER))]
        beam, walked = beam_search(points, norms, edges, middle, points[new], width)
        edges[new, :degree] = robust_prune(points, new, np.concatenate([beam, walked], axis=1), degree)
        _with_back_edges(points, edges, new, degree)
        at += len(new)
    return edges, _entries(edges, middle)


def lifted(m: np.ndarray) -> np.ndarray:
    """The vectors in units of the longest, with the component that makes all of that length."""
    largest = np.abs(m).max(initial=0) or 1.0
    unit = m / largest
    norms = (unit * unit).sum(axis=1)
    most = norms.max(initial=0) or 1.0
    return np.concatenate([unit, np.sqrt(np.maximum(most - norms, 0))[:, None]], axis=1).astype(np.float32) / np.float32(np.sqrt(most))


def bands(m: np.ndarray) -> list[np.ndarray]:
    """Rows by norm, each band within a factor BAND (the last one holds all shorter rows): in one
    graph over very different norms, the added component would set all rows far from any query."""
    largest = np.abs(m).max(initial=0) or 1.0
    norms = np.sqrt(((m / largest) ** 2).sum(axis=1))
    with np.errstate(divide="ignore"):
        band = np.minimum(np.floor(np.log(norms.max(initial=0) / norms) / np.log(BAND) + 1e-6), BANDS - 1).astype(int)
    return [np.flatnonzero(band == b) for b in np.unique(band)]


# ---------------------------------------------------------------- the index

_INDEX = "shard int, dim int, vectors binary, first binary, ids binary, edges binary, entry binary"


def _shard(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows of the index of one shard: nodes are distinct vectors, ids grouped by node, rising."""
    ids, count = (table.column(n).to_numpy() for n in ("vec_id", "n"))
    shard = table.column("shard")[0].as_py()
    for dim, at, m in matrices(np.arange(len(table)), table.column("v").combine_chunks()):
        m = m + 0.0  # one zero
        for some in bands(m):
            nodes, node = np.unique(m[some], axis=0, return_inverse=True)
            node = np.repeat(node.ravel(), count[at[some]])  # a row that is there n times is there n times
            own = np.repeat(ids[at[some]], count[at[some]])
            order = np.lexsort((own, node))
            first = np.searchsorted(node[order], np.arange(len(nodes) + 1))
            edges, entry = build(lifted(nodes))
            parts = (nodes, first.astype(np.int64), own[order].astype(np.int64), edges, entry)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "dim": pa.array([dim], pa.int32()),
                                              **{n: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for n, x in zip(("vectors", "first", "ids", "edges", "entry"), parts)}})


def taking_part(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows with an id and a finite vector that is not zero."""
    rows = doubles(vectors, F.col("vec_id").cast("long").alias("vec_id"))
    return rows.where(F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0))


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all vectors of ``taking_part``, one row for each shard, dimension and band.

    Rows that repeat an id and its vector are counted before they are dealt out, so that the rows
    to deal are distinct and their hash spreads them evenly."""
    rows = written(vectors.groupBy("vec_id", "v").agg(F.count("*").alias("n")), "neighbours-rows")
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((int(s), batch.filter(pa.compute.equal(batch.column("shard"), s))) for batch in batches for s in batch.column("shard").unique().to_pylist())
        for _, same in groupby(pieces, lambda piece: piece[0]):
            yield from _shard(pa.Table.from_batches([p for _, p in same]).combine_chunks())

    spread = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "vec_id", "v")
    return written(spread.mapInArrow(run, _INDEX), "neighbours-graphs")


class Graph:
    """A row of the index."""

    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, self.dim)
        self.first, self.ids = np.frombuffer(row["first"], np.int64), np.frombuffer(row["ids"], np.int64)
        self.edges = np.frombuffer(row["edges"], np.int32).reshape(len(self.vectors), -1)
        self.entry = np.frombuffer(row["entry"], np.int32)
        self.points = lifted(self.vectors)
        self.norms = (self.points * self.points).sum(axis=1)

    def nearest(self, ids: np.ndarray, rows: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vec_id, score) of the vectors found, the k best of each query at least (equal
        scores all); a query's own id is left out."""
        with np.errstate(all="ignore"):
            unit = rows / np.abs(rows).max(axis=1, keepdims=True)
        asked = np.concatenate([unit / np.linalg.norm(unit, axis=1, keepdims=True), np.zeros((len(rows), 1))], axis=1).astype(np.float32)
        width = min(max(width, 2 * k + 1), len(self.vectors))
        entry = self.entry if len(self.vectors) > width else np.arange(len(self.vectors), dtype=np.int32)
        beam, _ = beam_search(self.points, self.norms, self.edges, entry, asked, width)
        query, at = np.nonzero(beam >= 0)
        node = beam[query, at]
        with np.errstate(all="ignore"):
            score = (rows[query] * self.vectors[node]).sum(axis=1)
        score = np.where(np.isnan(score), -np.inf, score)
        # of a node's ids, its k + 1 smallest are enough
        copies = np.minimum(np.diff(self.first)[node], k + 1)
        each = np.repeat(np.arange(len(node)), copies)
        other = self.ids[each_in(self.first[node], copies)]
        query, score = query[each], score[each]
        good = ids[query] != other
        query, other, score = query[good], other[good], score[good]
        order = np.lexsort((other, -score, query))
        query, other, score = query[order], other[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        return query[place < k], other[place < k], score[place < k]


def searched(graphs: DataFrame, asked: DataFrame, k: int = 20, width: int = QUERY_BEAM) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k nearest that the beams over all graphs of the
    query's dimension find. ``asked``: (vec_id, v), taken in blocks of BLOCK_BYTES."""
    context = graphs.sparkSession.sparkContext
    blocks = 1 + (asked.agg(F.sum(8 * F.size("v") + 8)).first()[0] or 0) // BLOCK_BYTES
    found = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        shared = context.broadcast({dim: (ids, m) for batch in rows.to_batches() for dim, ids, m in matrices(batch.column("vec_id").to_numpy(), batch.column("v"))})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    if (dim := batch.column("dim")[i].as_py()) not in shared.value:
                        continue
                    ids, m = shared.value[dim]
                    graph = Graph({n: batch.column(n)[i].as_buffer() if n not in ("shard", "dim") else batch.column(n)[i].as_py() for n in batch.schema.names})
                    for lo in range(0, len(ids), TOGETHER):
                        query, other, score = graph.nearest(ids[lo:lo + TOGETHER], m[lo:lo + TOGETHER], k, width)
                        yield pa.RecordBatch.from_pydict({"query_id": ids[lo:lo + TOGETHER][query], "vec_id": other, "score": score})

        lists = graphs.mapInArrow(run, "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
        top = lists.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(written(top, "neighbours-found") if blocks > 1 else top)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 20, width: int = QUERY_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k vectors with the largest inner product (in
    doubles) to each query that beam searches of all shards' graphs find, ties to smaller vec_id.

    Every row is indexed, in shards of about ``shard_rows`` rows; shards with up to ``width``
    distinct vectors are searched whole. A query's own vec_id is no candidate, and only vectors of
    its dimension are. Rows without id, and vectors that are null, zero, empty or hold a null or
    non-finite component, take no part. Rows that repeat a vec_id count each as a candidate; the
    first of them by value is the query. Scores beyond the doubles are infinite, and a sum of
    infinities of both signs ranks as minus infinity."""
    rows = taking_part(vectors)
    asked = written(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "neighbours-queries")
    return searched(index(rows, shard_rows), asked, k, width)


def recall(found: DataFrame, vectors: DataFrame, is_query: Column, k: int = 20) -> float:
    """Share of the exact k nearest vectors' scores that the search has reached, counted by rank
    over all queries (for measuring: every query is compared with every vector, in tiles)."""
    rows = taking_part(vectors)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).toArrow().combine_chunks()
    queries = [(dim, ids, m) for batch in asked.to_batches() for dim, ids, m in matrices(batch.column("vec_id").to_numpy(), batch.column("v"))]
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.column("vec_id").to_numpy()
            for dim, at, m in matrices(np.arange(len(others)), batch.column("v")):
                for d, ids, q in shared.value:
                    for lo in range(0, len(ids) if d == dim else 0, 1024):
                        scores = np.where(ids[lo:lo + 1024, None] == others[at][None, :], -np.inf, q[lo:lo + 1024] @ m.T)
                        top = -np.sort(-scores, axis=1)[:, :k]
                        yield pa.RecordBatch.from_pydict({"query_id": np.repeat(ids[lo:lo + 1024], top.shape[1]), "score": top.ravel()})

    exact = rows.mapInArrow(run, "query_id long, score double").where(F.col("score") > float("-inf"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc()))
    least = exact.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("wanted"))
    got = found.join(least, "query_id").groupBy("query_id", "wanted").agg(F.sum((F.col("score") >= F.col("least") - 1e-9 * F.abs("least")).cast("int")).alias("reached"))
    sums = least.join(got.drop("wanted"), "query_id", "left").agg(F.sum("wanted"), F.sum(F.coalesce("reached", F.lit(0)))).first()
    return 1.0 if not sums[0] else sums[1] / sums[0]
