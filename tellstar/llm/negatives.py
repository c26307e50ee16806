"""Hard negatives by threshold joins over vectors.

For each anchor, first its positives (the rows of its class with the highest scores), then the
rows of other classes whose score lies in a window below each positive's. Both are threshold
joins: a task indexes a tile of its vectors by dimension, an anchor's partial scores are
accumulated over the postings, and what remains is bounded by norms. A vector's last dimensions
are left out of the index where their norm times the largest such norm of an anchor cannot reach
the threshold alone. Pairs and vectors that cannot reach it any more are pruned, the others are
finished exactly. Thresholds begin near the top and are lowered until each window holds its
rows, or is searched to its end. Tasks hand on their best rows of each window, which are merged.

Anchors are taken in blocks of a bounded number of bytes, each broadcast; scores are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import written
from .text import each_in
from .topk import best, matrices
from .vectors import doubles, floors, tiles

#: Vectors of a task's first index (lists that are full soon keep later thresholds high) and of
#: its last ones, and anchors that are joined with an index at once.
FIRST, ROWS, ANCHORS = 256, 4096, 256
#: Bytes of anchors and windows in one block (held by the driver and by every task).
BLOCK_BYTES = 8 << 20
#: Dimensions accumulated between two looks at the bounds.
STRIDE = 8
#: Pairs that are finished at once.
PAIRS = 1 << 16
#: Bounds are widened by this share of the norms' product, far above what rounding can lose.
SLACK = 1e-9
LEAST, LARGEST = -(1 << 63), (1 << 63) - 1


def rests(m: np.ndarray) -> np.ndarray:
    """Norm of each row's dimensions from every position on (one more column: 0)."""
    out = np.zeros((len(m), m.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1])
    return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner product of each row pair; one that no long holds is the nearest long."""
    out = np.empty(len(a), np.int64)
    most = np.abs(a).max(axis=1, initial=0) * np.abs(b).max(axis=1, initial=0) * a.shape[1]
    small = most < 2.0 ** 53
    out[small] = (a[small] * b[small]).sum(axis=1).astype(np.int64)
    for i in np.flatnonzero(~small).tolist():
        out[i] = min(max(sum(int(x) * int(y) for x, y in zip(a[i], b[i])), LEAST), LARGEST)
    return out


class Index:
    """Vectors by dimension, those of most energy first, with the norms of what is left."""

    def __init__(self, m: np.ndarray):
        self.order = np.argsort(-(m * m).sum(axis=0), kind="stable")
        self.m = m[:, self.order]
        self.rest = rests(self.m)

    def join(self, anchors: np.ndarray, anchor_rest: np.ndarray, need: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score) of all pairs whose score reaches the anchor's threshold; anchors
        have their dimensions in the order of the index."""
        dims = self.m.shape[1]
        widest, least = anchor_rest.max(axis=0), need.min()
        # a row's dimensions from ``kept`` on stay out: with any anchor they give less than ``least``
        reach = self.rest * widest + SLACK * self.rest[:, :1] * widest[0]
        kept = (reach[:, :-1] >= least).sum(axis=1) if least > 0 else np.full(len(self.m), dims)
        kept = np.minimum(-(-kept // STRIDE) * STRIDE, dims)
        rows = np.argsort(-kept, kind="stable")
        kept = kept[rows]
        if least > 0:  # rows without a posting cannot reach it
            n = int(np.searchsorted(-kept, 0, side="left"))
            rows, kept = rows[:n], kept[:n]
        sums = np.zeros((len(anchors), len(rows)))
        norms = SLACK * anchor_rest[:, :1] * self.rest[rows, 0]
        for lo in range(0, dims, STRIDE):
            n = int(np.searchsorted(-kept, -lo, side="left"))
            if not n:
                break
            hi = min(lo + STRIDE, dims)
            sums[:, :n] += anchors[:, lo:hi] @ self.m[rows[:n], lo:hi].T
            if hi < dims and hi % (2 * STRIDE) == 0:  # rows that no anchor can still reach go
                open_ = ~((sums[:, :n] + anchor_rest[:, hi:hi + 1] * self.rest[rows[:n], hi] + norms[:, :n]) < need[:, None])
                stay = np.concatenate([open_.any(axis=0), np.ones(len(rows) - n, bool)])
                if stay.sum() < 0.75 * len(stay):
                    rows, kept, sums, norms = rows[stay], kept[stay], sums[:, stay], norms[:, stay]
        bound = sums + anchor_rest[:, kept] * self.rest[rows, kept] + norms
        anchor, at = np.nonzero(~(bound < need[:, None]))
        for lo in range(0, len(anchor), PAIRS):
            a, j = anchor[lo:lo + PAIRS], at[lo:lo + PAIRS]
            score = exact(anchors[a], self.m[rows[j]])
            good = score >= need[a]
            yield a[good], rows[j[good]], score[good]


@dataclass
class Block:
    """Anchors of one dimension with the windows that are to be filled (ordered by anchor)."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    anchor: np.ndarray  # of each window: its anchor's place
    low: np.ndarray  # of each window: its least and largest score
    high: np.ndarray
    tag: np.ndarray  # of each window: its positive's rank, id


class Lists:
    """The best rows so far of every window of a block."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.window, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.first = np.searchsorted(block.anchor, np.arange(len(block.ids) + 1))

    def floor(self) -> np.ndarray:
        """The least score that can still enter each window."""
        low = self.block.low.copy()
        n = np.bincount(self.window, minlength=len(low))
        ends = np.cumsum(n) - 1  # lists are ordered by window, then score
        full = n >= self.k
        low[full] = np.maximum(low[full], self.score[ends[full]])
        return low

    def add(self, window: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        joined = [np.concatenate(x) for x in ((self.window, window), (self.id, ids), (self.score, score))]
        top = best(*joined, self.k)
        self.window, self.id, self.score = (x[top] for x in joined)

    def fill(self, index: Index, ids: np.ndarray, labels: np.ndarray, same: bool) -> None:
        """Adds a tile's rows, ANCHORS anchors at a time."""
        for lo in range(0, len(self.block.ids), ANCHORS):
            some = np.arange(lo, min(lo + ANCHORS, len(self.block.ids)))
            some = some[self.first[some + 1] > self.first[some]]  # an anchor without window asks nothing
            if len(some):
                self._fill(index, ids, labels, same, some)

    def _fill(self, index: Index, ids: np.ndarray, labels: np.ndarray, same: bool, todo: np.ndarray) -> None:
        block, floor = self.block, self.floor()
        mine = block.rows[todo][:, index.order]
        rest = rests(mine)
        reach = rest[:, 0] * index.rest[:, 0].max() * (1 + 1e-6) + 1
        widths = self.first[todo + 1] - self.first[todo]
        starts = np.cumsum(widths) - widths
        windows = each_in(self.first[todo], widths)
        least = np.minimum.reduceat(floor[windows], starts).astype(float)
        bottom = np.maximum(least - 1e-12 * np.abs(least), -reach)  # a double may lie above its integer
        top = np.minimum(np.maximum.reduceat(block.high[windows], starts).astype(float), reach)
        step = 1 / 16
        left = np.arange(len(todo))
        while len(left):
            need = top[left] - step * np.maximum(top[left] - bottom[left], 0)
            need = bottom[left] if step >= 1 else np.maximum(need, bottom[left])
            got = [np.concatenate(x) for x in zip(*self._hits(index, mine[left], rest[left], need, todo[left], ids, labels, same))]
            window, other, score = got if got else (np.empty(0, np.int64),) * 3
            own = np.bincount(window, minlength=len(block.anchor))
            done = np.array([bool(np.all((own[lo:hi] >= self.k) | (floor[lo:hi] >= t))) for lo, hi, t in zip(self.first[todo[left]], self.first[todo[left] + 1], need)]) | (step >= 1)
            over = np.zeros(len(block.ids), bool)
            over[todo[left[done]]] = True
            take = over[block.anchor[window]]
            self.add(window[take], other[take], score[take])
            left, step = left[~done], step * 1.5

    def _hits(self, index: Index, mine: np.ndarray, rest: np.ndarray, need: np.ndarray, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool):
        block = self.block
        for anchor, row, score in index.join(mine, rest, need):
            of = at[anchor]
            fits = ((block.labels[of] == labels[row]) == same) & (block.ids[of] != ids[row])
            of, row, score = of[fits], row[fits], score[fits]
            n = self.first[of + 1] - self.first[of]
            window, each = each_in(self.first[of], n), np.repeat(np.arange(len(of)), n)
            inside = (score[each] >= block.low[window]) & (score[each] <= block.high[window])
            window, each = window[inside], each[inside]
            yield window, ids[row[each]], score[each]


def filled(rows: DataFrame, blocks: list[Block], k: int, same: bool) -> DataFrame:
    """(anchor_id, positive_rank, positive_id, vec_id, score): every task's k best of each window."""
    shared = rows.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, size = [Lists(block, k) for block in shared.value], {}
        for table, by_dim in tiles(batches, ROWS):
            ids, labels = (table.column(n).to_numpy() for n in ("vec_id", "label"))
            for dim, (at, m) in by_dim.items():
                mine = [x for x in lists if x.block.rows.shape[1] == dim]
                lo = 0
                while mine and lo < len(at):
                    n = size.get(dim, FIRST)
                    index, some = Index(m[lo:lo + n]), at[lo:lo + n]
                    for x in mine:
                        x.fill(index, ids[some], labels[some], same)
                    lo, size[dim] = lo + n, min(2 * n, ROWS)
        for x in lists:
            b = x.block
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (b.ids[b.anchor[x.window]], b.tag[x.window, 0], b.tag[x.window, 1], x.id, x.score)],
                                             ["anchor_id", "positive_rank", "positive_id", "vec_id", "score"])

    return rows.mapInArrow(run, "anchor_id long, positive_rank long, positive_id long, vec_id long, score long")


def merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of each window over all tasks, numbered from 1."""
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_rank").orderBy(F.col("score").desc(), F.col("vec_id")))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k)


def _blocks(asked: DataFrame, bytes_of: Column) -> Iterator[pa.Table]:
    """Rows of ``asked`` in blocks of about BLOCK_BYTES."""
    size = asked.agg(F.sum(bytes_of)).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    for block in range(blocks if size else 0):
        yield asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()


def _anchors(table: pa.Table, windows) -> list[Block]:
    """Blocks by dimension; ``windows(places)`` gives each anchor's window counts, low, high and tags."""
    out = []
    column = table.column("v").combine_chunks() if len(table) else None
    for dim, at, m in matrices(np.arange(len(table)), column) if column is not None else []:
        ids, labels = (table.column(n).to_numpy()[at] for n in ("vec_id", "label"))
        counts, low, high, tag = windows(at)
        out.append(Block(ids, labels, m, np.repeat(np.arange(len(at)), counts), low, high, tag))
    return out


def _all(frames: list[DataFrame], like: DataFrame) -> DataFrame:
    out = frames[0] if frames else like
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def mined(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score,
    positive_rank): for each anchor and positive the first ``negatives`` rows of other labels with
    ``share[0] * positive_score <= share[1] * negative_score <= share[1] * positive_score``.

    Scores are integer inner products of floor(scale * x); higher ones come first, ties by smaller
    vec_id. Positives are the anchor's first rows of its own label. Rows without vec_id, label or
    vector, or with a null or non-finite component, take no part, and only vectors of the anchor's
    dimension meet it; its own vec_id is no candidate. Rows that repeat a vec_id count each as a
    candidate (and as a positive, told apart by ``positive_rank``); the first of them by vector and
    label is the anchor. Components are held to +-2^500 and scores to the range of a long."""
    own = F.col(label) if isinstance(label, str) else label
    kept = doubles(vectors, F.col("vec_id").cast("long").alias("vec_id"), own.cast("long").alias("label")).where("vec_id is not null and label is not null")
    rows = written(floors(kept, scale), "negatives-rows")
    asked = written(rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("a")).select("vec_id", "a.label", "a.v"), "negatives-anchors")
    empty = rows.sparkSession.createDataFrame([], "anchor_id long, positive_rank long, positive_id long, vec_id long, score long, rank int")

    def whole(at: np.ndarray):
        n = len(at)
        return np.ones(n, np.int64), np.full(n, LEAST), np.full(n, LARGEST), np.zeros((n, 2), np.int64)

    first = [written(merged(filled(rows, _anchors(t, whole), positives, same=True), positives), "negatives-positives") for t in _blocks(asked, 8 * F.size("v") + 48)]
    found = _all(first, empty).groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))  # at most ``positives`` of each
    asked = written(asked.join(found, asked.vec_id == found.anchor_id).drop("anchor_id"), "negatives-windows")
    second = []
    for t in _blocks(asked, 8 * F.size("v") + 40 * F.size("p") + 48):
        lists = t.column("p").to_pylist()

        def below(at: np.ndarray, lists=lists):
            own = [lists[i] for i in at.tolist()]
            flat = [w for p in own for w in p]
            # the least integer score s with share[0] * positive <= share[1] * s
            low = np.array([max(LEAST, -(-share[0] * w["score"] // share[1])) for w in flat], np.int64)
            return np.array([len(p) for p in own], np.int64), low, np.array([w["score"] for w in flat], np.int64), np.array([(w["rank"], w["vec_id"]) for w in flat], np.int64).reshape(-1, 2)

        block = _anchors(t, below)
        second.append(written(merged(filled(rows, block, negatives, same=False), negatives), "negatives-found"))
    ranked = _all(second, empty)
    known = _all(first, empty).select("anchor_id", F.col("rank").cast("long").alias("positive_rank"), F.col("score").alias("positive_score"))
    return ranked.join(known, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("positive_rank").cast("int").alias("positive_rank"))
