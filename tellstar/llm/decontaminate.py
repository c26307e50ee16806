"""Benchmark decontamination: test phrases searched in an FM-index of every training shard.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, compared
by a 64-bit hash. A test phrase is a window of 13 consecutive words of an item; an item with
fewer words, but not none, is one phrase. A shard is a run of whole documents inside a task
(about 1 MB of text, or one longer document). Its FM-index is built, searched and dropped in the
task, so nothing is shuffled and memory follows the shard, not the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fmindex import FmIndex
from .text import ALNUM_WORD, Chunk, Words, carried, each_in, map_chunks, record, restored, schema_of, texts

#: Benchmark text searched in one pass; a larger benchmark is searched block by block.
BLOCK_BYTES = 32 << 20


class Phrases:
    """The distinct windows of some items, and the items that hold each window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        data = np.frombuffer(b"".join(text for _, text in items), np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(text) for _, text in items]))).astype(np.int64)
        low = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
        words = Words(low, bounds, ALNUM_WORD)
        self.vocabulary, symbol = np.unique(words.hashes(), return_inverse=True)
        counts = words.counts()
        lengths = np.minimum(counts, window)
        windows = np.where(counts, counts - lengths + 1, 0)
        start = each_in(words.first[:-1], windows)
        size = np.repeat(lengths, windows)
        at = start[:, None] + size[:, None] - window + np.arange(window)
        shown = at >= start[:, None]
        rows = np.where(shown, (symbol + 2)[np.clip(at, 0, max(len(symbol) - 1, 0))], 0) if len(symbol) else at
        self.rows, which = np.unique(rows, axis=0, return_inverse=True)
        self.lengths = (self.rows > 0).sum(axis=1)
        self.names, named = np.unique(np.array([name for name, _ in items], object).astype(str), return_inverse=True) \
            if items else (np.empty(0, str), np.empty(0, np.int64))
        pairs = np.unique(np.stack([which.ravel(), np.repeat(named, windows)], axis=1), axis=0)
        self.item = pairs[:, 1]
        self.item_first = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.window = window

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """2 and more for words of the phrases, 1 for every other word."""
        if not len(self.vocabulary):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, 1)


def blocks(benchmark: DataFrame, window: int, limit: int = BLOCK_BYTES) -> Iterator[tuple[Phrases, bool]]:
    """Phrases of all items with an id, at most about ``limit`` bytes of item text in each block,
    and whether the block is the last one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    items = items.where("name is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // limit
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k)
        yield Phrases([(r.name, bytes(r.text)) for r in block.collect()], window), k == n - 1


def marked(docs: DataFrame, benchmark: DataFrame, finish: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, window: int = 13, *keep: str) -> DataFrame:
    """``finish`` of batches (doc_id, text binary, kept columns, n_words long, spans binary, items
    array<string>) of every row of ``docs``, as rows of ``schema``.

    ``spans`` are the merged runs of hit words: little-endian 64-bit pairs (first word, first
    word after) in order; ``items`` the sorted ids of items with an occurring window. A null or
    empty text has no words; an empty benchmark hits nothing; items without id take no part."""
    frame = texts(docs, *keep).withColumns({"n_words": F.lit(0).cast("long"), "spans": F.lit(b""), "items": F.array().cast("array<string>")})
    found = schema_of(frame)
    for phrases, last in blocks(benchmark, window):
        shared = docs.sparkSession.sparkContext.broadcast(phrases)

        def run(parts: Iterator[Chunk], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for part in parts:
                batch = _mark(part, shared)
                yield finish(batch) if last else batch

        frame = map_chunks(frame, run, schema if last else found)
    return frame


def _mark(part: Chunk, shared: Broadcast) -> pa.RecordBatch:
    phrases: Phrases = shared.value
    words = part.words(ALNUM_WORD, lower=True)
    place = np.arange(len(words)) + words.doc()
    seq = np.ones(len(words) + len(part) + 1, np.int64)  # a 1 after each document, 0 at the end
    seq[place] = phrases.symbols(words.hashes())
    seq[-1] = 0
    found, at = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(phrases.rows) and (seq > 1).any():
        index = FmIndex(seq, len(phrases.vocabulary) + 2)
        found, at = index.locate(*index.search(phrases.rows, phrases.lengths))
    doc = np.searchsorted(words.first + np.arange(len(words.first)), at, side="right") - 1
    word = at - doc
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + phrases.lengths[found], -1)
    hit = np.cumsum(cover[:-1]) > 0
    old = part.column("spans").to_pylist()
    for i, pairs in enumerate(old):
        for lo, hi in np.frombuffer(pairs, np.int64).reshape(-1, 2):
            hit[words.first[i] + lo:words.first[i] + hi] = True
    names = [set(x) for x in part.column("items").to_pylist()]
    for i, p in np.unique(np.stack([doc, found], axis=1), axis=0).tolist():
        names[i].update(phrases.names[phrases.item[phrases.item_first[p]:phrases.item_first[p + 1]]].tolist())
    spans = [runs(hit[a:b]).tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
    done = {"n_words": words.counts(), "spans": pa.array(spans, pa.binary()),
            "items": pa.array([sorted(x) for x in names], pa.list_(pa.string()))}
    return record(**{name: done.get(name, part.column(name)) for name in part.batch.schema.names})


def runs(hit: np.ndarray) -> np.ndarray:
    """(start, stop) pairs of the runs of true flags."""
    step = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], axis=1).astype(np.int64)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans array<struct<start,
    stop>>) for every row of ``docs``: contaminated if any word is hit and ``share`` times the
    hit words reach all words; ``spans`` are the word runs to remove."""
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,stop:long>>"

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in batch.column("spans").to_pylist()]
        n_hit = np.array([int((p[:, 1] - p[:, 0]).sum()) for p in pairs], np.int64)
        n_words = batch.column("n_words").to_numpy()
        items = batch.column("items").to_pylist()
        return record(
            doc_id=batch.column("doc_id"), n_words=n_words, n_hit=n_hit,
            n_items=np.array([len(x) for x in items], np.int64),
            items_sha256=pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            contaminated=(n_hit > 0) & (share * n_hit >= n_words),
            spans=pa.array([[{"start": a, "stop": b} for a, b in p.tolist()] for p in pairs], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))))

    return marked(docs, benchmark, digest, schema, window)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated documents; the rows that stay are unchanged."""
    frame, names = carried(docs)

    def stays(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_hit = np.array([int(np.diff(np.frombuffer(x, np.int64).reshape(-1, 2)).sum()) for x in batch.column("spans").to_pylist()], np.int64)
        keep = ~((n_hit > 0) & (share * n_hit >= batch.column("n_words").to_numpy()))
        return batch.select(names).filter(pa.array(keep))

    return restored(marked(frame, benchmark, stays, schema_of(frame, *names), window, *names[1:]), docs)
