"""Packing of documents into training sequences by Karmarkar-Karp multiway differencing.

A task takes its documents in blocks of about ``WINDOWS`` sequences. A document's ids are cut
into whole sequences and a rest, the rest into pieces; the pieces of a block go into k windows
of near-equal length by merging partial partitions with opposing imbalances (the largest
differences first, the fullest window of one with the emptiest of the other). While a window
exceeds the capacity, k rises. What a task has left at its end goes into sequences of powers of
two, which need no padding. Nothing is shuffled, and a task holds one block's ids.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .text import LOWER, PLAIN_WORD, Chunk, Words, byte_class, each_in, map_chunks, record, texts

#: Sequences that a block of pieces fills.
WINDOWS = 256
#: Units remembered by a worker process (about 36 bytes each); the memory is emptied when full.
REMEMBERED = 1_000_000
#: Fixed value: the pattern of the tokenizer whose units can be encoded one by one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes that part units: ASCII letters and digits from other printable ASCII but the apostrophe.
LETTER = byte_class((0x30, 0x39), (0x61, 0x7A))
MARK = byte_class((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


class Ids:
    """Token ids of whole texts by the tokenizer's library.

    Where the tokenizer file lower-cases, drops white space and splits by WORD_PATTERN, its ids
    of a text are those of the text's units: runs without ASCII white space, parted between
    letters and marks (never at an apostrophe or beside a byte over 0x7F). Each unit is encoded
    once while its hash is remembered. Other tokenizers, and texts that hold the string of a
    special token, are encoded as they are."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_unit = steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": WORD_PATTERN} and first.get("behavior") == "Removed"
        self.special = [t["content"].lower().encode() for t in spec["added_tokens"]]
        self._empty()

    def _empty(self) -> None:
        self.hash = np.empty(0, np.uint64)
        self.first = np.empty(0, np.int32)
        self.size = np.empty(0, np.int32)
        self.flat = np.empty(0, np.uint32)

    def _encode(self, batch: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch([t.decode("utf-8", "replace") for t in batch], add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        found = self._encode(units)
        size = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))])
        at = np.searchsorted(self.hash, hashes)
        self.hash, self.first, self.size = (np.insert(x, at, y) for x, y in ((self.hash, hashes), (self.first, first), (self.size, size)))

    def of(self, part: Chunk, end: int) -> list[np.ndarray]:
        """The ids of each text, and the end id behind them."""
        direct = [i for i in range(len(part)) if not self.by_unit]
        low = LOWER[part.data]
        if self.by_unit and b"<|" in (raw := low.tobytes()):
            direct = [i for i in range(len(part)) if any(x in raw[part.bounds[i]:part.bounds[i + 1]] for x in self.special)]
        units = Units(low, part.bounds)
        hashes = units.hashes()
        distinct, where, of = np.unique(hashes, return_index=True, return_inverse=True)
        for _ in range(2):
            at = np.searchsorted(self.hash, distinct)
            new = self.hash[np.minimum(at, len(self.hash) - 1)] != distinct if len(self.hash) else np.ones(len(distinct), bool)
            if not new.any():
                break
            if len(self.hash) and len(self.hash) + int(new.sum()) > REMEMBERED:
                self._empty()
                continue
            self._learn(distinct[new], [units.get(i) for i in where[new]])
        at = np.searchsorted(self.hash, distinct)[of] if len(distinct) else np.empty(0, np.int64)
        sizes = self.size[at].astype(np.int64)
        ids = self.flat[each_in(self.first[at].astype(np.int64), sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[units.first]
        out = [np.append(ids[a:b], np.uint32(end)) for a, b in zip(ends[:-1], ends[1:])]
        for i, own in zip(direct, self._encode([part.bytes_of(i) for i in direct]) if direct else []):
            out[i] = np.array([*own, end], np.uint32)
        return out


class Units(Words):
    """Runs without ASCII white space, parted between letters and marks (lower-cased bytes)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        super().__init__(data, bounds, PLAIN_WORD)
        letter, mark = LETTER[data], MARK[data]
        cut = np.flatnonzero((letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])) + 1
        cut = cut[~np.isin(cut, bounds)]  # a text's first byte starts a unit anyway
        self.start = np.sort(np.concatenate([self.start, cut]))
        self.end = np.sort(np.concatenate([self.end, cut]))
        self.first = np.searchsorted(self.start, bounds)


_ids: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The worker process's tokenizer and what it remembers, kept from task to task."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of each item, by multiway largest differencing.

    A partial partition is the sums of its windows in falling order, less the smallest, with
    the merge node of each window that is not empty."""
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merged, nodes, ticket = [], len(sizes), len(sizes)
    while len(heap) > 1:
        _, _, a, a_node = heapq.heappop(heap)
        _, _, b, b_node = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - k)
        b, b_node = b[::-1], b_node[::-1]
        node = np.concatenate([a_node, b_node[over:]])
        value = np.concatenate([a, b[over:]])
        if over:
            meet = slice(len(a) - over, len(a))
            new = np.arange(nodes, nodes + over)
            merged.append((new, a_node[meet], b_node[:over]))
            node[meet], nodes = new, nodes + over
            value[meet] += b[:over]
        order = np.argsort(-value, kind="stable")
        value, node = value[order], node[order]
        if len(value) == k:
            value -= value[-1]
        heapq.heappush(heap, (-int(value[0] - (value[-1] if len(value) == k else 0)), ticket, value, node))
        ticket += 1
    window = np.empty(nodes, np.int64)
    if heap:
        window[heap[0][3]] = np.arange(len(heap[0][3]))
    for new, a, b in reversed(merged):
        window[a] = window[b] = window[new]
    return window[:len(sizes)]


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece (at most ``capacity`` long); the count rises until all fit."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = differencing(sizes, k)
        if np.bincount(found, sizes).max() <= capacity:
            return found
        k += 1


class Packer:
    """Blocks of one task: pieces wait until they fill a block's windows."""

    def __init__(self, base: int, capacity: int, piece: int):
        self.base, self.capacity, self.piece = base, capacity, piece
        self.next = 0
        self.waiting: list[tuple[int, int, int]] = []  # (document, start, length)
        self.total = 0

    def add(self, doc: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        whole = n // self.capacity
        for i in range(whole):
            yield doc, i * self.capacity, self.capacity, self._id(), 0
        for start in range(whole * self.capacity, n, self.piece):
            self.waiting.append((doc, start, min(self.piece, n - start)))
        self.total += n - whole * self.capacity
        if self.total >= WINDOWS * self.capacity:
            yield from self._block()

    def _id(self) -> int:
        self.next += 1
        return self.base + self.next - 1

    def _room(self, k: int) -> int:
        """What k windows take at once: one part in 512 is left to their differences."""
        return k * (self.capacity - self.capacity // 512)

    def _block(self) -> Iterator[tuple[int, int, int, int, int]]:
        """Windows of the pieces that wait; the cut-off rest waits on."""
        k = self.total // self.capacity
        if not k:
            return
        ends = np.cumsum([p[2] for p in self.waiting])
        room = self._room(k)
        n = int(np.searchsorted(ends, room))
        pieces, rest = self.waiting[:n], self.waiting[n:]
        left = room - (int(ends[n - 1]) if n else 0)
        if rest and left:  # cut the piece that lies across
            doc, start, length = rest[0]
            pieces.append((doc, start, min(left, length)))
            rest = [(doc, start + left, length - left)] * (length > left) + rest[1:]
        found = windows(np.array([p[2] for p in pieces]), self.capacity)
        self.waiting, self.total = rest, sum(p[2] for p in rest)
        names: dict[int, int] = {}
        filled: dict[int, int] = {}
        for (doc, start, length), w in zip(pieces, found.tolist()):
            if w not in names:
                names[w] = self._id()
            yield doc, start, length, names[w], filled.get(w, 0)
            filled[w] = filled.get(w, 0) + length

    def end(self) -> Iterator[tuple[int, int, int, int, int]]:
        while self.total >= self.capacity:
            yield from self._block()
        left, name, offset, size = self.total, 0, 0, 0
        for doc, start, length in self.waiting:
            while length:
                if offset == size:  # the next power of two
                    name, offset, size = self._id(), 0, 1 << (left.bit_length() - 1)
                take = min(length, size - offset)
                yield doc, start, take, name, offset
                start, length, offset, left = start + take, length - take, offset + take, left - take
        self.waiting, self.total = [], 0


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 2, piece: int = 512, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids array<int>]): one
    row for each piece. A document's ids are those of its whole text (null: empty) and ``end``.
    sequence_id is the task's number in the high 32 bits and a count in the low ones; rows that
    repeat a document are packed like others; an empty table gives no row. ``tokenizer`` is a
    path that every executor can open."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 32, capacity, piece)
        names: dict[int, int | None] = {}
        held: dict[int, np.ndarray] = {}
        count = 0

        def rows(found: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
            doc, start, length, name, offset = (list(x) for x in zip(*found))
            cut = [held[d][s:s + n] for d, s, n in zip(doc, start, length)]
            more = {"ids": pa.array([c.astype(np.int32) for c in cut], pa.list_(pa.int32()))} if with_ids else {}
            out = record(
                doc_id=pa.array([names[d] for d in doc], pa.int64()), start=np.array(start), length=np.array(length),
                ids_crc32=np.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut], np.int64),
                doc_tokens=np.array([len(held[d]) for d in doc]), sequence_id=np.array(name), offset=np.array(offset), **more)
            waiting = {d for d, _, _ in packer.waiting}
            for d in [d for d in held if d not in waiting]:
                del held[d], names[d]
            return out

        for part in parts:
            found = []
            for name, own in zip(part.column("doc_id").to_pylist(), ids.of(part, end)):
                names[count], held[count] = name, own
                found += packer.add(count, len(own))
                count += 1
            if found:
                yield rows(found)
        if found := list(packer.end()):
            yield rows(found)

    return map_chunks(texts(docs), run, schema + (", ids array<int>" if with_ids else ""))
