"""Language-model scores by a hidden Markov model over whole texts.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (known by a
64-bit hash) and one end token. Every token belongs to a symbol: a frequent word is its own
symbol; the other words share one symbol per class of spelling (first and last two bytes), inside
which a word has the smoothed share of its training count. Counts of all words are summed by
hash bucket over all partitions. The symbols of the training documents are written once; the clusters
of the first model and every Baum-Welch round are sums over all of them. The likelihood of a
text is exact: a scaled forward recursion over its whole symbol sequence, for many texts at once. In
training, too, a text is one sequence.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import fold, written
from .substring import binaries
from .text import PLAIN_WORD, Chunk, each_in, map_chunks, mixed, record, texts

#: The held-out share of documents: crc32(doc_id) mod FOLDS = 0.
FOLDS = 10
#: At most so many words are symbols of their own (also the bound of the broadcast tables).
FREQUENT = 1 << 16
#: Spelling classes of the other words.
CLASSES = 1024
#: Latent states: so many text clusters at the start, two states each.
CLUSTERS, STATES = 4, 8
#: Rounds of the clusters (each over all training documents), and the least tokens of a text
#: that one of them begins with (shorter ones only if there is no other).
CLUSTER_ROUNDS, LEAST_SEED = 5, 50
#: Training rounds: the share of the training documents (by hash) that each one sums over.
ROUNDS = (1, 1, 1, 1, 1)
#: Tokens of texts that are trained on at once in a task: short texts, and texts of over LENGTHY
#: tokens (together, so that a step of theirs is worth its overhead); whose values are held at
#: once; and that are scored at once.
TRAINED, LENGTHY, LENGTHY_TRAINED, BLOCK = 500_000, 1024, 2_000_000, 2_000_000
SCORED = 3_000_000
ADD = 0.1


def spelling(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class of each word: a hash of its first and last two bytes."""
    a, b = data[start].astype(np.uint64), data[np.minimum(start + 1, end - 1)].astype(np.uint64)
    c, d = data[np.maximum(end - 2, start)].astype(np.uint64), data[end - 1].astype(np.uint64)
    return (mixed(a | b << np.uint64(8) | c << np.uint64(16) | d << np.uint64(24)) % np.uint64(CLASSES)).astype(np.int64)


class Tokens:
    """Words of a chunk with hash and class."""

    def __init__(self, part: Chunk):
        words = part.words(PLAIN_WORD, lower=True)
        self.first, self.count = words.first, words.counts()
        self.hash = words.hashes()
        self.kind = spelling(words.data, words.start, words.end) if len(words) else np.empty(0, np.int64)


# ---------------------------------------------------------------- word counts

def _sums(keys: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, kinds = keys[order], kinds[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts, kinds[first]


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, keys, counts, kinds): every distinct word of the training documents once, packed
    in ordered runs; summed inside each task before the rows are dealt out."""

    def count(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, counts, kinds = held.pop()
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edge = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            sizes = np.diff(np.append(edge, len(order)))
            return record(bucket=pa.array(bucket[order][edge], pa.int32()), keys=binaries(keys[order], sizes),
                          counts=binaries(counts[order], sizes), kinds=binaries(kinds[order].astype(np.uint16), sizes))

        for part in parts:
            tokens = Tokens(part)
            held.append(_sums(tokens.hash, np.ones(len(tokens.hash), np.int64), tokens.kind))
            if len(held) > 1:
                held = [_sums(*map(np.concatenate, zip(*held)))]
            if len(held[0][0]) > 1 << 20:
                yield flush()
        if held and len(held[0][0]):
            yield flush()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(batches, "bucket"):
            held = None
            for row in rows:
                own = (np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64), np.frombuffer(row["kinds"], np.uint16))
                held = _sums(*own) if held is None else _sums(*map(np.concatenate, zip(held, own)))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), **{n: [x.tobytes()] for n, x in zip(("keys", "counts", "kinds"), held)}})

    schema = "bucket int, keys binary, counts binary, kinds binary"
    packed = map_chunks(texts(docs).where(fold("doc_id", FOLDS) != 0), count, schema)
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(total, schema)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows of ordered batches, run by run of equal keys (each run is read to its end first)."""
    from itertools import groupby

    def rows() -> Iterator[dict]:
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                yield {n: (batch.column(n)[i].as_buffer() if pa.types.is_binary(batch.column(n).type) else batch.column(n)[i].as_py()) for n in names}

    return groupby(rows(), lambda row: row[key])


@dataclass
class Words:
    """The frequent words (ordered hashes and their counts) and the totals of the rest by class.

    Symbols: 0 is the end, 1 to len(keys) the frequent words, then the classes."""

    keys: np.ndarray
    counts: np.ndarray
    ends: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.counts.sum() + self.ends + self.class_tokens.sum())

    @property
    def distinct(self) -> int:
        return int(len(self.keys) + (self.ends > 0) + self.class_words.sum())

    @property
    def symbols(self) -> int:
        return 1 + len(self.keys) + CLASSES

    def lookup(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each word, and its place among the frequent ones (-1: it is not)."""
        if not len(self.keys):
            return 1 + tokens.kind, np.full(len(tokens.hash), -1)
        at = np.minimum(np.searchsorted(self.keys, tokens.hash), len(self.keys) - 1)
        known = self.keys[at] == tokens.hash
        return np.where(known, 1 + at, 1 + len(self.keys) + tokens.kind), np.where(known, at, -1)

    def unigram(self) -> np.ndarray:
        """Smoothed share of each symbol."""
        mass = np.concatenate(([self.ends + ADD], self.counts + ADD, self.class_tokens + ADD * (self.class_words + 1)))
        return mass / mass.sum()

    def within(self) -> np.ndarray:
        """log10 of what a class word's count + ADD is divided by."""
        return np.log10(self.class_tokens + ADD * (self.class_words + 1))


def vocabulary(counts: DataFrame, ends: int, limit: int = FREQUENT) -> Words:
    """The words whose count reaches the least one that at most ``limit`` words reach."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield record(key=np.frombuffer(batch.column("keys")[i].as_buffer(), np.int64), n=np.frombuffer(batch.column("counts")[i].as_buffer(), np.int64),
                             kind=np.frombuffer(batch.column("kinds")[i].as_buffer(), np.uint16).astype(np.int32))

    rows = counts.mapInArrow(spread, "key long, n long, kind int")
    # one row for each count that occurs: at most the root of twice the tokens
    sizes = rows.groupBy("n").count().orderBy(F.col("n").desc())
    least, total = None, 0
    for r in sizes.toLocalIterator():
        total += r["count"]
        if total > limit:
            break
        least = r["n"]
    frequent = rows.where(F.col("n") >= least).toArrow() if least is not None else None
    classes = rows.where(F.col("n") < least) if least is not None else rows
    tokens, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in classes.groupBy("kind").agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).collect():
        tokens[r.kind], words[r.kind] = r.tokens, r.words
    if frequent is None:
        return Words(np.empty(0, np.uint64), np.empty(0, np.int64), ends, tokens, words)
    keys = frequent.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Words(keys[order], frequent.column("n").to_numpy()[order], ends, tokens, words)


# ---------------------------------------------------------------- the model

@dataclass
class Model:
    """Start (states), steps (from, to) and shown (symbol, state) probabilities."""

    start: np.ndarray
    step: np.ndarray
    shown: np.ndarray

    def steady(self) -> np.ndarray:
        p = self.start
        for _ in range(200):
            p = p @ self.step
        return p / p.sum()


def forward(model: Model, symbol: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log10 likelihood of each sequence (size >= 1), all of them one time step after the other."""
    order = np.argsort(-size, kind="stable")
    at, size = first[order], size[order]
    alpha = model.start * model.shown[symbol[at]]
    scale = alpha.sum(axis=1)
    log = np.log10(scale)
    alpha /= scale[:, None]
    live = np.searchsorted(-size, -np.arange(size[0] + 1), side="left") if len(size) else []
    for t in range(1, size[0] if len(size) else 0):
        n = live[t]  # sequences longer than t
        now = (alpha[:n] @ model.step) * model.shown[symbol[at[:n] + t]]
        scale = now.sum(axis=1)
        log[:n] += np.log10(scale)
        alpha = now / scale[:, None]
    out = np.empty(len(log))
    out[order] = log
    return out


def expected(model: Model, symbol: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts (start, steps, shown) of whole sequences (size >= 1).

    The tokens lie step by step: those of step t are one run, longest sequences first, so that a
    recursion's operand is a slice. Forward and backward values are single precision and keep any
    scale (brought back every few steps); what they give for a token or a step is divided by its
    own sum at the end, for all at once. Steps are taken in blocks of about BLOCK tokens: the
    forward values at each block's start are kept, and the block's own are worked out again."""
    k = len(model.start)
    order = np.argsort(-size, kind="stable")
    at, size = first[order], size[order]
    live = np.searchsorted(-size, -np.arange(size[0] + 1), side="left")  # sequences longer than t
    peak = model.shown.max(axis=1)
    table = (model.shown / peak[:, None]).astype(np.float32)
    least = max(float((model.shown.min(axis=1) / peak).min()), 1e-15)
    every = max(1, int(15 / max(1.0, -np.log10(least))))  # steps until a sum may lose 15 digits of scale
    step, back = model.step.astype(np.float32), np.ascontiguousarray(model.step.T.astype(np.float32))
    one = np.ones(k, np.float32)
    edges, held = [0], 0
    for t, n in enumerate(live[:-1].tolist()):
        held += n
        if held >= BLOCK and t + 1 < size[0]:
            edges.append(t + 1)
            held = 0
    edges.append(int(size[0]))

    def tokens(lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the block's steps, and the symbol of each of its tokens."""
        widths = live[lo:hi]
        off = np.concatenate(([0], np.cumsum(widths)))
        place = np.arange(off[-1]) - np.repeat(off[:-1], widths)
        return off, symbol[at[place] + np.repeat(np.arange(lo, hi), widths)]

    def forwards(shown: np.ndarray, off: list[int], before: np.ndarray | None, out: np.ndarray) -> None:
        """Forward values of a block; ``before`` are those of the step before it."""
        lo, last = 0, len(off) - 2
        for t, hi in enumerate(off[1:]):
            now = out[lo:hi]
            if before is None:
                np.multiply(shown[lo:hi], model.start.astype(np.float32), out=now)
            else:
                np.dot(before[:hi - lo], step, out=now)
                now *= shown[lo:hi]
            if t % every == every - 1 or t == last:
                now /= np.dot(now, one)[:, None]
            before, lo = now, hi

    kept: list[np.ndarray | None] = [None]  # forward values before each block
    for lo, hi in zip(edges[:-2], edges[1:-1]):
        off, own = tokens(lo, hi)
        alpha = _room("alpha", off[-1], k)
        forwards(np.take(table, own, axis=0, out=_room("ahead", off[-1], k), mode="clip"), off.tolist(), kept[-1], alpha)
        kept.append(alpha[off[-2]:].copy())
    start, steps, counts = np.zeros(k), np.zeros((k, k)), np.zeros((len(model.shown), k))
    after = np.empty((0, k), np.float32)  # of the step after the block: shown times backward values
    for lo, hi, before in zip(edges[-2::-1], edges[:0:-1], kept[::-1]):
        bounds, own = tokens(lo, hi)
        off = bounds.tolist()
        alpha, beta = _room("alpha", off[-1], k), _room("beta", off[-1], k)
        ahead = np.take(table, own, axis=0, out=_room("ahead", off[-1], k), mode="clip")
        forwards(ahead, off, before, alpha)
        for t in range(hi - lo - 1, -1, -1):
            now, n = beta[off[t]:off[t + 1]], len(after)
            if n:
                some = now[:n]
                np.dot(after, back, out=some)
                if t % every == every - 1 or t == 0:
                    some /= np.dot(some, one)[:, None]
            now[n:] = 1
            after = ahead[off[t]:off[t + 1]]
            after *= now
        after = after.copy()  # the room is used again
        if before is not None:
            steps += _pairs(before[:off[1]], ahead[:off[1]], step)
        # steps with as many sequences lie one behind the other, and so do the steps before them
        runs = np.flatnonzero(np.diff(np.diff(bounds), prepend=-1)).tolist() + [hi - lo]
        for a, b in zip(runs[:-1], runs[1:]):
            if a:
                steps += _pairs(alpha[off[a - 1]:off[a - 1] + off[a + 1] - off[a]], ahead[off[a]:off[a + 1]], step)
            if b - a > 1:
                steps += _pairs(alpha[off[a]:off[b - 1]], ahead[off[a + 1]:off[b]], step)
        alpha *= beta
        alpha /= np.dot(alpha, one)[:, None]
        if lo == 0:
            start += alpha[:off[1]].sum(axis=0, dtype=np.float64)
        for s in range(k):
            counts[:, s] += np.bincount(own, alpha[:, s], len(counts))
    return start, steps * model.step, counts


_rooms: dict[str, np.ndarray] = {}


def _room(name: str, rows: int, columns: int) -> np.ndarray:
    """Memory that the worker uses again for each batch (new pages cost more than the sums)."""
    held = _rooms.get(name)
    if held is None or held.size < rows * columns:
        held = _rooms[name] = np.empty(rows * columns, np.float32)
    return held[:rows * columns].reshape(rows, columns)


def _pairs(alpha: np.ndarray, ahead: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Sum over pairs of tokens of their states' joint share, without the step probability."""
    total = np.einsum("ij,ij->i", np.dot(alpha, step), ahead)
    return np.dot(alpha.T, ahead / total[:, None]).astype(np.float64)


def renewed(words: Words, start: np.ndarray, steps: np.ndarray, shown: np.ndarray) -> Model:
    """Probabilities of expected counts; states lean on the unigram share of every symbol."""
    shown = shown + 200.0 * words.unigram()[:, None]
    steps = steps + 1.0
    start = start + 1.0
    return Model(start / start.sum(), steps / steps.sum(axis=1, keepdims=True), shown / shown.sum(axis=0))


def sequences(parts: Iterator[Chunk], words: Words, limit: int) -> Iterator[tuple[list[Chunk], list[Tokens], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols of whole texts with their end, until about ``limit`` tokens are together."""
    chunks, tokens, places, pieces, sizes = [], [], [], [], []

    def out():
        size = np.concatenate(sizes)
        return chunks[:], tokens[:], places[:], np.concatenate(pieces), np.cumsum(size) - size, size

    for part in parts:
        own = Tokens(part)
        symbol, place = words.lookup(own)
        flat = np.zeros(len(symbol) + len(part), np.int32)  # 0, the end, stays behind each text
        flat[np.arange(len(symbol)) + np.repeat(np.arange(len(part)), own.count)] = symbol
        for held, x in zip((chunks, tokens, places, pieces, sizes), (part, own, place, flat, own.count + 1)):
            held.append(x)
        if sum(map(len, pieces)) >= limit:
            yield out()
            for held in (chunks, tokens, places, pieces, sizes):
                held.clear()
    if pieces:
        yield out()


def symbols(training: DataFrame, words: Words) -> DataFrame:
    """(doc_id, text) of ``training``; the text is its symbols with the end (32-bit integers)."""
    shared = training.sparkSession.sparkContext.broadcast(words)

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, _, _, symbol, _, size in sequences(iter([part]), shared.value, 0):
                yield record(doc_id=part.column("doc_id"), text=binaries(symbol, size))

    return map_chunks(training, run, "doc_id long, text binary")


def bags(parts: Iterator[Chunk]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_id, symbol, first, size) of rows of ``symbols``: batches of short texts, and of long."""
    held: dict[bool, list[tuple[pa.Array, np.ndarray, np.ndarray]]] = {False: [], True: []}

    def out(kind: bool):
        ids, symbol, size = zip(*held[kind])
        held[kind].clear()
        size = np.concatenate(size)
        return pa.concat_arrays(ids), np.concatenate(symbol), np.cumsum(size) - size, size

    for part in parts:
        size, symbol = np.diff(part.bounds) // 4, np.ascontiguousarray(part.data).view(np.int32)
        ids = part.column("doc_id")
        for kind, limit in ((False, TRAINED), (True, LENGTHY_TRAINED)):
            some = (size > LENGTHY) == kind
            if some.any():
                held[kind].append((ids.filter(pa.array(some)), symbol if some.all() else symbol[np.repeat(some, size)], size[some]))
                if sum(len(x[1]) for x in held[kind]) >= limit:
                    yield out(kind)
    for kind in held:
        if held[kind]:
            yield out(kind)


def summed(written_symbols: DataFrame, fn: Callable[..., tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray] | None:
    """Sums of ``fn(symbol, first, size)`` (some numbers, and a table with a row for each symbol)
    over all texts, by symbol block; None without texts."""
    width = 1024

    def count(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        sums = None
        for _, symbol, first, size in bags(parts):
            own = fn(symbol, first, size)
            sums = own if sums is None else tuple(a + b for a, b in zip(sums, own))
        if sums is not None:
            few, table = sums
            blocks = [table[lo:lo + width] for lo in range(0, len(table), width)]
            task = TaskContext.get().partitionId()
            yield record(block=pa.array(range(-1, len(blocks)), pa.int32()), task=pa.array([task] * (len(blocks) + 1), pa.int32()),
                         data=[few.tobytes(), *[b.astype(np.float32).tobytes() for b in blocks]])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _runs(batches, "block"):
            sums = 0.0
            for row in rows:
                sums = sums + np.frombuffer(row["data"], np.float64 if block < 0 else np.float32).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "data": [sums.tobytes()]})

    sums = map_chunks(written_symbols, count, "block int, task int, data binary").repartition("block").sortWithinPartitions("block", "task")
    found = {r.block: np.frombuffer(bytes(r.data), np.float64) for r in sums.mapInArrow(total, "block int, data binary").collect()}
    return (found[-1], np.concatenate([found[b] for b in sorted(found) if b >= 0])) if found else None


def trained(docs: DataFrame, words: Words, rounds: tuple[int, ...] = ROUNDS) -> Model:
    """Baum-Welch over partitions: every round's expected counts are summed by symbol block."""
    spark = docs.sparkSession
    training = written(symbols(texts(docs).where(fold("doc_id", FOLDS) != 0), words), "hmm-symbols")
    model = first_model(training, words)
    for share in rounds:
        shared = spark.sparkContext.broadcast(model)

        def count(symbol: np.ndarray, first: np.ndarray, size: np.ndarray, shared=shared) -> tuple[np.ndarray, np.ndarray]:
            start, steps, shown = expected(shared.value, symbol, first, size)
            return np.concatenate([start, steps.ravel()]), shown

        some = training.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0) if share > 1 else training
        found = summed(some, count)
        if found is not None:
            few, shown = found
            model = renewed(words, few[:STATES], few[STATES:].reshape(STATES, STATES), shown.reshape(-1, STATES))
    return model


def first_model(training: DataFrame, words: Words) -> Model:
    """Two states (frequent and other symbols) for each of CLUSTERS clusters of the texts of
    ``symbols``. A cluster begins with one text, of all texts the one that the clusters so far
    fit worst (the first: the longest text), and is then a mixture component of all texts."""
    context = training.sparkSession.sparkContext
    base = words.unigram()
    mix = np.empty((0, len(base)))
    for _ in range(CLUSTERS):
        seed = _worst(training, context.broadcast(np.log(mix / base)))
        if seed is None:
            mix = np.tile(base, (CLUSTERS, 1))
            break
        mix = np.concatenate([mix, [0.5 * base + 0.5 * np.bincount(seed, minlength=len(base)) / len(seed)]])
    for _ in range(CLUSTER_ROUNDS):
        shared = context.broadcast(np.log(mix))

        def count(symbol: np.ndarray, first: np.ndarray, size: np.ndarray, shared=shared) -> tuple[np.ndarray, np.ndarray]:
            fit = np.stack([np.add.reduceat(m[symbol], first) for m in shared.value])
            weight = np.exp(fit - fit.max(axis=0))
            weight /= weight.sum(axis=0)
            return weight @ size, np.stack([np.bincount(symbol, np.repeat(w, size), len(base)) for w in weight], axis=1)

        found = summed(training, count)
        if found is None:
            break
        tokens, table = found
        mix = table.reshape(-1, CLUSTERS).T + 0.01 * tokens.sum() / CLUSTERS * base
        mix /= mix.sum(axis=1, keepdims=True)
    often = np.zeros(len(base), bool)
    often[np.argsort(-base, kind="stable")[:256]] = True
    shown = np.stack([m * np.where(often == side, 1.0, 0.2) for m in mix for side in (True, False)], axis=1)
    near = np.arange(STATES) // 2
    step = np.where(near[:, None] == near[None, :], 0.47, 0.06 / max(1, STATES - 2))
    return Model(np.full(STATES, 1 / STATES), step / step.sum(axis=1, keepdims=True), shown / shown.sum(axis=0))


def _worst(training: DataFrame, shared) -> np.ndarray | None:
    """The symbols of the text with the least log-odds a token in its best cluster (without a
    cluster: the longest text), ties by doc_id; a task hands on its own worst text only."""

    def find(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        best = None
        for ids, symbol, first, size in bags(parts):
            fit = np.stack([np.add.reduceat(m[symbol], first) for m in shared.value]).max(axis=0) / np.maximum(size, LEAST_SEED) if len(shared.value) else -size.astype(float)
            short, ids = size < LEAST_SEED, ids.fill_null(-1).to_numpy()
            at = np.lexsort((ids, fit, short))[0]
            own = bool(short[at]), float(fit[at]), int(ids[at]), symbol[first[at]:first[at] + size[at]].tobytes()
            best = own if best is None else min(best, own)
        if best is not None:
            yield record(**{name: [x] for name, x in zip(("short", "fit", "doc_id", "text"), best)})

    rows = map_chunks(training, find, "short boolean, fit double, doc_id long, text binary").orderBy("short", "fit", "doc_id", "text").limit(1).collect()
    return np.frombuffer(bytes(rows[0].text), np.int32) if rows else None


# ---------------------------------------------------------------- scores

def scores(docs: DataFrame, rounds: tuple[int, ...] = ROUNDS, limit: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    A null or empty text is the end token alone. Rows that repeat a doc_id are scored one by one
    (and counted one by one in training). Without training rows all counts are 0."""
    spark = docs.sparkSession
    buckets = max(64, docs.rdd.getNumPartitions() // 2)
    counts = written(word_counts(docs, buckets), "hmm-counts")
    words = vocabulary(counts, docs.where(fold("doc_id", FOLDS) != 0).count(), limit)
    model = trained(docs, words, rounds)
    shared = spark.sparkContext.broadcast((words, model))
    marked = texts(docs.select("doc_id", "text").withColumn("held_out", fold("doc_id", FOLDS) == 0), "held_out")
    known = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, frequent double, score double"
    first_pass = written(map_chunks(marked, lambda parts: _first_pass(parts, shared, buckets), known + ", bucket int, rows binary, sizes binary, keys binary"), "hmm-scored")
    probes = first_pass.where("row is null").select("bucket", F.lit(1).alias("kind"), "rows", "sizes", "keys", F.lit(None).cast("binary").alias("counts"))
    table = counts.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("rows"), F.lit(None).cast("binary").alias("sizes"), "keys", "counts")
    dealt = probes.unionByName(table).repartition("bucket").sortWithinPartitions("bucket", "kind")
    rare = dealt.mapInArrow(_rare, "row long, n long, log double").groupBy("row").agg(F.sum("n").alias("rare_known"), F.sum("log").alias("rare_log"))
    whole = math.log10(words.tokens + ADD * (words.distinct + 1))
    rows = first_pass.where("row is not null").select(*[c.split()[0] for c in known.split(", ")]).join(rare, "row", "left")
    log, more = F.coalesce("rare_log", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    return rows.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
                       (F.col("frequent") + log - F.col("n_tokens") * F.lit(whole)).alias("base_score"), (F.col("score") + log).alias("score"))


def _first_pass(parts: Iterator[Chunk], shared, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each text's score without the counts of its other words, and these words by bucket."""
    words, model = shared.value
    log = np.log10(np.append(words.counts, 0) + ADD)  # the last: not frequent
    log[-1] = 0.0
    within = words.within()
    row = TaskContext.get().partitionId() << 33
    for chunks, tokens, places, symbol, first, size in sequences(parts, words, SCORED):
        score = forward(model, symbol, first, size)
        at = 0
        for part, own, place in zip(chunks, tokens, places):
            n = len(part)
            of = np.repeat(np.arange(n), own.count)
            rare = place < 0
            ids = row + np.arange(n)
            row += n
            frequent = np.bincount(of, log[place], minlength=n) + math.log10(words.ends + ADD)
            share = score[at:at + n] - np.bincount(of[rare], within[own.kind[rare]], minlength=n)
            at += n
            yield record(row=ids, doc_id=part.column("doc_id"), held_out=part.column("held_out"), n_tokens=own.count + 1,
                         n_known=np.bincount(of[~rare], minlength=n) + (words.ends > 0), frequent=frequent, score=share,
                         bucket=pa.nulls(n, pa.int32()), rows=pa.nulls(n, pa.binary()), sizes=pa.nulls(n, pa.binary()), keys=pa.nulls(n, pa.binary()))
            key, of = own.hash[rare], of[rare]
            if not len(key):
                continue
            pair = (key % np.uint64(buckets)).astype(np.int64) * n + of
            order = np.argsort(pair, kind="stable")
            edge = np.flatnonzero(np.diff(pair[order], prepend=-1))
            sizes, bucket = np.diff(np.append(edge, len(pair))), pair[order][edge] // n
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            held = np.diff(np.append(heads, len(bucket)))
            m = len(heads)
            yield record(row=pa.nulls(m, pa.int64()), doc_id=pa.nulls(m, pa.int64()), held_out=pa.nulls(m, pa.bool_()), n_tokens=pa.nulls(m, pa.int64()),
                         n_known=pa.nulls(m, pa.int64()), frequent=pa.nulls(m, pa.float64()), score=pa.nulls(m, pa.float64()), bucket=pa.array(bucket[heads], pa.int32()),
                         rows=binaries(ids[pair[order][edge] % n], held), sizes=binaries(sizes.astype(np.int32), held), keys=binaries(key[order], np.add.reduceat(sizes, heads)))


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket the word counts, then each row's sum of log10(count + ADD) and known words."""
    for _, rows in _runs(batches, "bucket"):
        keys, logs, seen = np.empty(0, np.uint64), np.empty(0), np.empty(0, np.int64)
        for row in rows:
            own = np.frombuffer(row["keys"], np.uint64)
            if row["kind"] == 0:
                counts = np.frombuffer(row["counts"], np.int64)
                order = np.argsort(own)
                keys, seen = own[order], counts[order]
                logs = np.log10(seen + ADD)
                continue
            ids, sizes = np.frombuffer(row["rows"], np.int64), np.frombuffer(row["sizes"], np.int32)
            of = np.repeat(np.arange(len(ids)), sizes)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                found = keys[at] == own
            else:
                at, found = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
            log = np.where(found, logs[at], math.log10(ADD)) if len(keys) else np.full(len(own), math.log10(ADD))
            yield record(row=ids, n=np.bincount(of[found], minlength=len(ids)), log=np.bincount(of, log, minlength=len(ids)))
