"""Whole texts inside a task: Arrow batches to byte buffers, words and word hashes (numpy)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task (a longer document is handled alone and whole).
CHUNK_BYTES = 1 << 20
#: Most bytes of a word that is hashed by a polynomial.
LONG = 32
#: Rows of the Arrow batches that tasks exchange with Python (Spark's default is five times as
#: many; a batch is held about twice on either side).
BATCH_ROWS = 2000


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true for the bytes of the given inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+``.
PLAIN_WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (of lower-cased text).
ALNUM_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Byte map that lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the text as UTF-8 bytes (null: empty) and the kept columns."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        *[F.col(c) for c in keep],
    )


class Chunk:
    """Some documents of a batch: one byte buffer and each document's bounds in it."""

    def __init__(self, batch: pa.RecordBatch, lo: int, hi: int, data: np.ndarray, bounds: np.ndarray):
        self.batch, self.lo, self.hi = batch, lo, hi
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return self.hi - self.lo

    def column(self, name: str) -> pa.Array:
        return self.batch.column(name).slice(self.lo, len(self))

    def words(self, table: np.ndarray, lower: bool = False) -> "Words":
        return Words(LOWER[self.data] if lower else self.data, self.bounds, table)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()


class Words:
    """Word bounds in a buffer; ``first[i]:first[i + 1]`` are the words of document i."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        inside = table[data]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[bounds[:-1][bounds[:-1] < len(data)]] = False
        self.data, self.bounds = data, bounds
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        cuts = bounds[1:] - 1
        after[cuts[cuts >= 0]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, bounds)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a polynomial modulo 2**64 of up to LONG bytes. Longer
        words are hashed one by one by XXH3 (over many bytes, such polynomials of two words can be
        equal whatever their multiplier is)."""
        up, down = powers(_ROOTS[seed], len(self.data))
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:len(self.data)], out=sums[1:])
        size = self.end - self.start
        found = mixed((sums[self.end] - sums[self.start]) * down[self.start] + size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG).tolist():
            found[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i]:self.end[i]], seed)
        return found

    def get(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


#: Odd multipliers of the polynomial hashes, one for each seed.
_ROOTS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(root: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``root**i`` and its inverse modulo 2**64 for i < n at least; tables up to one chunk are kept."""
    up, down = _powers.get(root, (None, None))
    if up is None or len(up) < n:
        size = max(n, 1 << 16)
        up = _geometric(root, size)
        down = _geometric(pow(root, -1, 1 << 64), size)
        if size <= CHUNK_BYTES + 1:
            _powers[root] = up, down
    return up, down


def _geometric(root: int, n: int) -> np.ndarray:
    out = np.full(n, root, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolling(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` consecutive word hashes (runs cross document bounds)."""
    if len(words) < length:
        return np.empty(0, np.uint64)
    up, down = powers(_ROOTS[seed], len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    n = len(words) - length + 1
    return mixed((sums[length:] - sums[:-length]) * down[:n])


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Slices of batches with at most ``limit`` bytes of text, or one longer document each."""
    for batch in batches:
        column = batch.column("text")
        if batch.num_rows == 0:
            continue
        kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
            yield Chunk(batch, lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            lo = hi


def map_chunks(frame: DataFrame, fn: Callable[[Iterator[Chunk]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the chunks of every partition of a frame from ``texts``. Sets the session's
    Arrow batches to BATCH_ROWS rows, where they are larger (Spark reads this when a plan runs)."""
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(chunks(batches))

    return frame.mapInArrow(run, schema)


def carried(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` as a frame for ``map_chunks`` that also carries every original column under a
    name of its own, and those names (``restored`` gives the columns back)."""
    names = [f"_keep{i}" for i in range(len(docs.columns))]
    own = docs.select(F.col("doc_id"), F.col("text"), F.col("text").isNull().alias("_null"), *[
        F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names) if c != "text"])
    keep = ["_null"] + [n for c, n in zip(docs.columns, names) if c != "text"]
    return texts(own, *keep), ["text", *keep]


def restored(frame: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of a ``carried`` frame as rows of ``docs``."""
    text = F.when(~F.col("_null"), F.col("text").cast("string"))
    return frame.select(*[(text if c == "text" else F.col(f"_keep{i}")).alias(c) for i, c in enumerate(docs.columns)])


def schema_of(frame: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {frame.schema[n].dataType.simpleString()}" for n in names or frame.columns)


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def each_in(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)
