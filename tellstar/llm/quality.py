"""Quality classifier: a generalised additive model with pairwise interactions.

Each document is described by numbers of its whole text. Boosting goes round the features in
turn; a shallow tree on one feature's bins is fitted to the current gradients and added, shrunk,
to that feature's lookup table. Then pairs of features with the largest gain on what is left
are boosted the same way on their joint bins. A score is the sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import fold, written
from .text import PLAIN_WORD, Chunk, byte_class, map_chunks, record, texts

#: The share of labelled rows that no fit may see: crc32(doc_id) mod FOLDS = 0.
FOLDS = 5
#: Bound of the labelled sample that a model is fitted on (lowest hashes of doc_id).
SAMPLE = 20_000

FEATURES = ("log_bytes", "log_words", "word_length", "long_words", "upper", "digits", "punctuation", "other_bytes", "blanks", "newlines",
            "distinct_words", "top_word", "distinct_pairs", "top_pair", "same_as_before", "line_words", "distinct_lines", "short_lines",
            "bangs", "bars", "symbols", "marked_ends", "capital_starts", "longest_run")

UPPER, LOWERS, DIGIT = byte_class((0x41, 0x5A)), byte_class((0x61, 0x7A)), byte_class((0x30, 0x39))
PUNCTUATION = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
SYMBOL = byte_class((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5E, 0x60), (0x7E, 0x7E))


def _share(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Share of true flags in each run."""
    sums = np.concatenate(([0], np.cumsum(flags)))
    sizes = np.diff(bounds)
    return np.diff(sums[bounds]) / np.maximum(sizes, 1)


def _variety(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values per group as a share of its values, and the share of its most common."""
    sizes = np.bincount(of, minlength=n)
    order = np.lexsort((hashes, of))
    key, group = hashes[order], of[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(key)))
    distinct = np.bincount(group[first], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, group[first], counts)
    return distinct / np.maximum(sizes, 1), most / np.maximum(sizes, 1)


def describe(part: Chunk) -> np.ndarray:
    """One row of FEATURES for each document; a text without words has shares of 0."""
    n, data, bounds = len(part), part.data, part.bounds
    words = part.words(PLAIN_WORD)
    counts, of = words.counts(), words.doc()
    hashes = words.hashes()
    length = words.end - words.start
    distinct, top = _variety(hashes, of, n)
    follows = np.flatnonzero(of[1:] == of[:-1]) if len(of) else np.empty(0, np.int64)
    pairs = hashes[follows] * np.uint64(0x9E3779B97F4A7C15) + hashes[follows + 1] if len(follows) else np.empty(0, np.uint64)
    distinct_pairs, top_pair = _variety(pairs, of[follows], n)
    newline = data == 0x0A
    # lines: runs of words with no newline between them
    at_line = np.concatenate(([0], np.cumsum(newline)))[words.start] if len(words) else np.empty(0, np.int64)
    starts = np.ones(len(words), bool)
    starts[1:] = (at_line[1:] != at_line[:-1]) | (of[1:] != of[:-1])
    line = np.flatnonzero(starts)
    line_words = np.diff(np.append(line, len(words)))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(hashes, out=sums[1:])
    ends = np.append(line, len(words))
    distinct_lines, _ = _variety(sums[ends[1:]] - sums[ends[:-1]], of[line], n)
    lines = np.bincount(of[line], minlength=n)
    run = np.flatnonzero(np.concatenate(([True], (data[1:] != data[:-1])))) if len(data) else np.empty(0, np.int64)
    run = np.union1d(run, bounds[:-1][np.diff(bounds) > 0])
    runs = np.diff(np.append(run, len(data)))
    longest = np.zeros(n)
    np.maximum.at(longest, np.searchsorted(bounds, run, side="right") - 1, runs)
    by_word = lambda flags: np.bincount(of, flags, minlength=n) / np.maximum(counts, 1)
    again = np.zeros(len(words), bool)
    again[follows + 1] = hashes[follows] == hashes[follows + 1]
    last = data[words.end - 1] if len(words) else data[:0]
    columns = [
        np.log1p(np.diff(bounds)), np.log1p(counts), by_word(length), by_word(length > 12),
        _share(UPPER[data], bounds), _share(DIGIT[data], bounds), _share(PUNCTUATION[data], bounds), _share(data >= 0x80, bounds),
        _share(data == 0x20, bounds), _share(newline, bounds), distinct, top, distinct_pairs, top_pair, by_word(again),
        counts / np.maximum(lines, 1), distinct_lines, np.bincount(of[line], line_words < 4, minlength=n) / np.maximum(lines, 1),
        _share(data == 0x21, bounds), _share(data == 0x7C, bounds), _share(SYMBOL[data], bounds), by_word(SYMBOL[last] | (last == 0x21)),
        by_word(UPPER[data[words.start]] if len(words) else np.empty(0)), np.log1p(longest)]
    return np.stack(columns, axis=1).astype(np.float32) if n else np.empty((0, len(FEATURES)), np.float32)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, features array<float>) of every row's whole text (null: empty)."""

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = describe(part)
            offsets = pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32())
            yield record(doc_id=part.column("doc_id"), features=pa.ListArray.from_arrays(offsets, pa.array(rows.ravel())))

    return map_chunks(texts(docs), run, "doc_id long, features array<float>")


@dataclass
class Additive:
    """Bin edges of the features, their tables, and the tables of pairs."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def bins(self, rows: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(self.edges)]

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for table, b in zip(self.tables, self.bins(rows)):
            out += table[b]
        for i, j, first, second, table in self.pairs:
            out += table[np.searchsorted(first, rows[:, i], side="right"), np.searchsorted(second, rows[:, j], side="right")]
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return (distinct[1:] + distinct[:-1]) / 2
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _split(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> tuple[float, int]:
    """Largest gain of cutting a run of bins in two, and the cut (0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = np.where((left_h >= least) & (right_h >= least), left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge), -np.inf)
    if not len(gain) or not np.isfinite(gain.max()):
        return 0.0, 0
    cut = int(gain.argmax())
    return float(gain[cut] - g.sum() ** 2 / (h.sum() + ridge)), cut + 1


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> float:
    return float(g.sum() / (h.sum() + ridge))


def _tree(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> np.ndarray:
    """Values of the bins by a tree of depth two on them."""
    out = np.empty(len(g))
    _, cut = _split(g, h, least, ridge)
    for lo, hi in ((0, cut), (cut, len(g))):
        if lo == hi:
            continue
        _, more = _split(g[lo:hi], h[lo:hi], least, ridge)
        for a, b in ((lo, lo + more), (lo + more, hi)):
            if a < b:
                out[a:b] = _leaf(g[a:b], h[a:b], ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> tuple[np.ndarray, float]:
    """A tree that cuts one feature, then the other on each side (the better order of the two)."""
    found = []
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        best_gain, best_out = 0.0, np.full(gg.shape, _leaf(gg, hh, ridge))
        for cut in range(1, gg.shape[0]):
            out, gain = np.empty(gg.shape), -gg.sum() ** 2 / (hh.sum() + ridge)
            for side in (slice(0, cut), slice(cut, None)):
                a, b = gg[side].sum(axis=0), hh[side].sum(axis=0)
                _, at = _split(a, b, least, ridge)
                for part in (slice(0, at), slice(at, None)):
                    if len(a[part]):
                        out[side, part] = _leaf(a[part], b[part], ridge)
                        gain += a[part].sum() ** 2 / (b[part].sum() + ridge)
            if gain > best_gain:
                best_gain, best_out = gain, out
        found.append((best_gain, best_out.T if turn else best_out))
    return max(found, key=lambda x: x[0])[::-1]


def fit(rows: np.ndarray, label: np.ndarray, rounds: int = 120, pairs: int = 6, pair_rounds: int = 20, rate: float = 0.15,
        bins: int = 64, pair_bins: int = 8, least: float = 2.0, ridge: float = 1.0) -> Additive:
    """The additive model of 0/1 labels; no labels or labels of one class give a constant.

    Every seventh row is not fitted on; the rounds end when they stop improving on those rows."""
    share = (label.sum() + 0.5) / (len(label) + 1)
    base = float(np.log(share / (1 - share)))
    if len(label) == 0 or label.min() == label.max():
        return Additive(base, [np.empty(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [])
    edges = [_edges(rows[:, i], bins) for i in range(rows.shape[1])]
    at = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    margin = np.full(len(label), base)
    used = np.arange(len(label)) % 7 != 0
    if len(label) < 70:
        used[:] = True
    check = ~used if not used.all() else used

    def chance() -> np.ndarray:
        return np.where(used, 1 / (1 + np.exp(-margin)), label)  # no gradient from rows held back

    def loss() -> float:
        return float(np.logaddexp(0, np.where(label[check] > 0, -margin[check], margin[check])).mean())

    best = (loss(), [t.copy() for t in tables], margin.copy(), 0)
    for turn in range(rounds):
        for i, b in enumerate(at):
            if len(tables[i]) < 2:
                continue
            p = chance()
            g, h = np.bincount(b, label - p, len(tables[i])), np.bincount(b, p * (1 - p), len(tables[i]))
            step = rate * _tree(g, h, least, ridge)
            tables[i] += step
            margin += step[b]
        if (now := loss()) < best[0]:
            best = (now, [t.copy() for t in tables], margin.copy(), turn)
        elif turn - best[3] >= 10:
            break
    _, tables, margin, _ = best
    coarse = [_edges(rows[:, i], pair_bins) for i in range(rows.shape[1])]
    near = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(coarse)]
    shape = [len(e) + 1 for e in coarse]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell, p = near[i] * shape[j] + near[j], chance()
        n = shape[i] * shape[j]
        return cell, np.bincount(cell, label - p, n).reshape(shape[i], shape[j]), np.bincount(cell, p * (1 - p), n).reshape(shape[i], shape[j])

    useful = [i for i in range(len(shape)) if shape[i] > 1]
    gains = sorted(((_pair_tree(*sums(i, j)[1:], least, ridge)[1], i, j) for i, j in combinations(useful, 2)), reverse=True)
    chosen = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in gains[:pairs]]
    best = (loss(), [t.copy() for *_, t in chosen], 0)
    for _ in range(pair_rounds):
        for i, j, table in chosen:
            cell, g, h = sums(i, j)
            step = rate * _pair_tree(g, h, least, ridge)[0]
            table += step
            margin += step.ravel()[cell]
        if (now := loss()) < best[0]:
            best = (now, [t.copy() for *_, t in chosen], 0)
    chosen = [(i, j, t) for (i, j, _), t in zip(chosen, best[1])]
    return Additive(base, edges, tables, [(i, j, coarse[i], coarse[j], t) for i, j, t in chosen])


def labelled_sample(labels: DataFrame, column: str, size: int = SAMPLE) -> DataFrame:
    """(doc_id, label): up to ``size`` labelled ids outside the held-out fold, by lowest hash of
    the id (one row for each id, its largest label; null ids and labels left out)."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).dropna()
    rows = rows.where(fold("doc_id", FOLDS) != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def train(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """The model of ``labels.quality`` from a bounded sample of the rows of ``described``."""
    chosen = F.broadcast(labelled_sample(labels, "quality", sample))  # at most ``sample`` rows
    table = features.join(chosen, "doc_id").orderBy("doc_id", "features").limit(2 * sample).toArrow()
    rows = table.column("features").combine_chunks()
    values = rows.values.to_numpy().reshape(len(table), len(FEATURES)) if len(table) else np.empty((0, len(FEATURES)), np.float32)
    return fit(values, table.column("label").to_numpy().astype(float))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The text is read once; its features are written and serve the fit and the scores. Rows that
    repeat a doc_id are scored by their own texts. Without labelled rows the score is a constant.
    """
    features = written(described(docs), "quality-features")
    shared = docs.sparkSession.sparkContext.broadcast(train(features, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
            score = shared.value.score(rows)
            yield record(doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=score, predicted=pa.array((score >= threshold).astype(np.int32)))

    marked = features.withColumn("held_out", fold("doc_id", FOLDS) == 0)
    return marked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
