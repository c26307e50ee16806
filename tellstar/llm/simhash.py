"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits.

The links come from an inverted index on byte positions with count filtering. Two 64-bit
fingerprints that differ in at most d bits agree in at least 8 - d of their 8 byte positions,
so every link lies in the intersection of that many positional posting lists. The index holds
these intersections as postings (positions, their bytes); within one posting list the equal
bytes of each pair are tallied, pairs that reach the minimum and meet here first (the lowest
positions they share) are kept, and their differing bits are counted. A list gives back no
pairs but a spanning forest of its links, so its output grows with its length only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components, looked_up, roots
from .folds import written
from .text import LOWER, Chunk, each_in, map_chunks, record, texts

#: Longest posting list whose pairs are compared directly; longer ones are split by more bits.
DENSE = 16384
#: Lists up to this length are compared together, one shift of the sorted batch at a time.
SHORT = 64


def fingerprints(docs: DataFrame, shingle: int = 4, *keep: str) -> DataFrame:
    """(doc_id, fp long, kept columns) for every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. A bit is set if over
    half of the shingles' XXH64 (seed 42) have it, repeats counted. Fewer words than a shingle
    are one shingle; no word (null, empty, blank text) gives 0.
    """

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            low = LOWER[part.data]
            fps = np.zeros(len(part), np.uint64)
            for i in range(len(part)):
                fps[i] = fingerprint(low[part.bounds[i]:part.bounds[i + 1]].tobytes(), shingle)
            yield record(doc_id=part.column("doc_id"), fp=fps.view(np.int64), **{k: part.column(k) for k in keep})

    frame = texts(docs, *keep)
    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in frame.schema.fields[2:])
    return map_chunks(frame, run, "doc_id long, fp long" + kept)


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    hashes = np.fromiter((digest(whole[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        bits = np.unpackbits(hashes[lo:lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int((1 << np.flatnonzero(2 * counts > n).astype(object)).sum())


class Positions:
    """The position sets of ``need`` equal parts out of 64 / width, and a pair's first common set."""

    def __init__(self, need: int):
        self.need = need
        self.sets = list(combinations(range(8), need))
        self.masks = [sum(0xFF << (8 * p) for p in s) for s in self.sets]
        index = {s: i for i, s in enumerate(self.sets)}
        self.first = np.full(256, -1, np.int16)
        for shared in range(256):
            held = [p for p in range(8) if shared >> p & 1]
            if len(held) >= need:
                self.first[shared] = index[tuple(held[:need])]

    def meets(self, x: np.ndarray, which: np.ndarray | int, bits: int) -> np.ndarray:
        """Of XORs of pairs in a list of the set ``which``: tally of equal bytes, first set, bits."""
        ok = np.bitwise_count(x) <= bits
        equal = (x[ok].reshape(-1, 1).view(np.uint8) == 0)
        tally = np.packbits(equal, axis=1, bitorder="little")[:, 0]
        ok[ok] = self.first[tally] == (which[ok] if isinstance(which, np.ndarray) else which)
        return ok


def links(fps: DataFrame, bits: int = 4) -> DataFrame:
    """(a, b) longs: edges that connect exactly the components of "at most ``bits`` differing
    bits" among the distinct values of ``fps.fp``. Every pair within the distance is examined."""
    if not 0 <= bits <= 7:
        raise ValueError("bits must be 0 to 7")
    positions = Positions(8 - bits)
    nodes = fps.select("fp").distinct()

    def postings(frame: DataFrame, masks: list[int], *more: Column) -> DataFrame:
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        lists = F.array(*[F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.lit(m)).alias("held")) for i, m in enumerate(signed)])
        return frame.select("fp", *more, F.explode(lists).alias("list")).select("fp", *more, "list.at", "list.held")

    def scan(frame: DataFrame, keys: list[str], probe) -> DataFrame:
        dealt = frame.repartition(*keys).sortWithinPartitions(*keys)
        limit = DENSE
        return dealt.mapInArrow(lambda batches: probe(_whole_lists(batches, keys, limit)), "a long, b long, at int, held long")

    def direct(lists) -> Iterator[pa.RecordBatch]:
        for table, bounds, long_list in lists:
            fp, at, held = (table[c] for c in ("fp", "at", "held"))
            if long_list:  # not compared here: its members go on to the finer lists
                yield _rows(fp, fp, at, held)
                continue
            a, b = _forest(fp.view(np.uint64), at, bounds, lambda x, w: positions.meets(x, w, bits))
            yield _rows(fp[a], fp[b], np.full(len(a), -1, np.int32), np.zeros(len(a), np.int64))

    first = written(scan(postings(nodes, positions.masks), ["at", "held"], direct), "simhash-links")
    edges = first.where("at < 0").select("a", "b")
    crowded = first.where("at >= 0")
    if crowded.limit(1).count():
        edges = edges.unionByName(_finer(crowded, positions, bits))
    return edges


def _finer(crowded: DataFrame, positions: Positions, bits: int) -> DataFrame:
    """Links within the lists longer than DENSE. What is free there is 8 * bits bits, dealt
    into 2 * bits nibbles of which at least ``bits`` agree, so that at most 4 * bits bits stay
    open: a finer list has 2 ** (4 * bits) distinct members at most (65,536 for 4 bits), which are
    compared directly, member by member until each is reached."""
    nibbles = [[8 * p + o for p in range(8) if p not in s for o in (0, 4)] for s in positions.sets]
    finer = [[sum(0xF << n for n in c) for c in combinations(own, bits)] for own in nibbles]
    width = len(finer[0])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(finer, np.uint64).reshape(len(finer), width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                fp, at, held = (part.column(c).to_numpy() for c in ("a", "at", "held"))
                more = (fp.view(np.uint64)[:, None] & table[at]).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "fp": np.repeat(fp, width), "at": pa.array(np.repeat(at, width), pa.int32()), "held": np.repeat(held, width),
                    "sub": pa.array(np.tile(np.arange(width), len(fp)), pa.int32()), "more": more.ravel()})

    keys = ["at", "held", "sub", "more"]
    dealt = crowded.mapInArrow(spread, "fp long, at int, held long, sub int, more long").repartition(*keys).sortWithinPartitions(*keys)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds, _ in _whole_lists(batches, keys, limit=None):
            fp = table["fp"]
            a, b = _forest(fp.view(np.uint64), table["at"], bounds, lambda x, w: np.bitwise_count(x) <= bits)
            yield pa.RecordBatch.from_pydict({"a": fp[a], "b": fp[b]})

    return dealt.mapInArrow(probe, "a long, b long")


def _rows(a, b, at, held) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": a, "b": b, "at": pa.array(at, pa.int32()), "held": held})


def _whole_lists(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int | None) -> Iterator[tuple[dict, np.ndarray, bool]]:
    """Runs of whole lists from sorted batches: their columns, the bounds of the lists, and
    whether this is a part of one list that is longer than ``limit`` (which never gathers)."""
    held: dict[str, np.ndarray] | None = None
    crowded = None
    for batch in batches:
        table = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if not batch.num_rows:
            continue
        if crowded is not None:  # the rest of a long list
            n = int(np.argmin(_same(table, keys, crowded))) if not _same(table, keys, crowded).all() else batch.num_rows
            if n:
                yield {c: v[:n] for c, v in table.items()}, np.array([0, n]), True
            if n == batch.num_rows:
                continue
            table, crowded = {c: v[n:] for c, v in table.items()}, None
        if held is not None:
            table = {c: np.concatenate([held[c], table[c]]) for c in table}
        n = len(table["fp"])
        cut = np.zeros(n, bool)
        for c in keys:
            cut[1:] |= table[c][1:] != table[c][:-1]
        cut[0] = True
        bounds = np.append(np.flatnonzero(cut), n)
        last = int(bounds[-2])  # may go on in the next batch
        if last:
            yield from _split({c: v[:last] for c, v in table.items()}, bounds[:-1], limit)
        held = {c: v[last:].copy() for c, v in table.items()}
        if limit is not None and n - last > limit:
            crowded = {c: held[c][0] for c in keys}
            yield held, np.array([0, n - last]), True
            held = None
    if held is not None:
        yield from _split(held, np.array([0, len(held["fp"])]), limit)


def _split(table: dict, bounds: np.ndarray, limit: int | None) -> Iterator[tuple[dict, np.ndarray, bool]]:
    sizes = np.diff(bounds)
    crowded = sizes > limit if limit is not None else np.zeros(len(sizes), bool)
    for i in np.flatnonzero(crowded):
        yield {c: v[bounds[i]:bounds[i + 1]] for c, v in table.items()}, np.array([0, sizes[i]]), True
    some = np.flatnonzero(~crowded & (sizes > 1))
    if len(some):
        rows = each_in(bounds[some], sizes[some])
        yield {c: v[rows] for c, v in table.items()}, np.concatenate(([0], np.cumsum(sizes[some]))), False


def _same(table: dict, keys: list[str], key: dict) -> np.ndarray:
    same = np.ones(len(table["fp"]), bool)
    for c in keys:
        same &= table[c] == key[c]
    return same


def _forest(fp: np.ndarray, at: np.ndarray, bounds: np.ndarray, meets) -> tuple[np.ndarray, np.ndarray]:
    """Rows (member, root) that span the links inside each list; ``meets(xor, at)`` tells links."""
    sizes = np.diff(bounds)
    of = np.repeat(np.arange(len(sizes)), sizes)
    brief = np.flatnonzero(np.repeat(sizes <= SHORT, sizes))
    low, high = [], []
    for shift in range(1, SHORT):
        brief = brief[:np.searchsorted(brief, len(fp) - shift)]
        brief = brief[of[brief] == of[brief + shift]]
        if not len(brief):
            break
        met = brief[meets(fp[brief] ^ fp[brief + shift], at[brief])]
        low.append(met)
        high.append(met + shift)
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (low, high))
    label = roots(a, b, len(fp))
    for i in np.flatnonzero(sizes > SHORT):
        lo, hi = bounds[i], bounds[i + 1]
        label[lo:hi] = lo + _reach(fp[lo:hi], int(at[lo]), meets)
    far = np.flatnonzero(label != np.arange(len(fp)))
    return far, label[far]


def _reach(fp: np.ndarray, at: int, meets) -> np.ndarray:
    """First member reached for every member of one list; the unreached shrink as links are met."""
    label = np.arange(len(fp))
    rest = np.arange(len(fp))
    while len(rest):
        seed, rest = rest[0], rest[1:]
        front = np.array([seed])
        while len(front) and len(rest):
            step, front = front[:max(1, (1 << 20) // len(rest))], front[max(1, (1 << 20) // len(rest)):]
            pairs = fp[step][:, None] ^ fp[rest][None, :]
            met = meets(pairs.ravel(), at).reshape(pairs.shape).any(axis=0)
            label[rest[met]] = seed
            front = np.concatenate([front, rest[met]])
            rest = rest[~met]
    return label


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id that links reach (itself included; null only where
    all doc_ids of the component are null). Copies share one fingerprint and are never paired;
    documents without words share fingerprint 0. Repeated rows stay; an empty table gives none.
    """
    return _classified(docs, shingle, bits).select("doc_id", "fp", "component_id")


def _classified(docs: DataFrame, shingle: int, bits: int, *keep: str) -> DataFrame:
    """(doc_id, fp, root, component_id, kept columns); ``root`` is a component's own fingerprint."""
    # a row's place in its task, written with it: neither copies nor components land in one task
    place = F.monotonically_increasing_id().alias("place")
    marks = written(fingerprints(docs, shingle, *keep).select("*", place), "simhash-fingerprints")
    lowest = marks.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    joined = components(links(marks, bits))
    rooted = written(lowest.join(joined, lowest.fp == joined.node, "left").select("fp", "lowest", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    smallest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    classes = looked_up(rooted, "root", F.xxhash64("fp"), smallest).select("fp", "root", "component_id")
    return looked_up(marks, "fp", F.col("place"), classes).select("doc_id", "fp", "root", "component_id", *keep)


def keep_one(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with its smallest doc_id.

    Rows are told apart by doc_id and text, so texts of different groups that share a doc_id all
    stay. Of a group's rows with its smallest doc_id the one whose text has the smallest hash
    stays, and of its exact repetitions one. Rows without doc_id all stay."""
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = _classified(docs.select("doc_id", "text", mark.alias("mark")), shingle, bits, "mark")
    own = found.where("doc_id = component_id").groupBy("root", "doc_id", "mark").count()
    first = own.groupBy("root").agg(F.min(F.struct("mark", "count", "doc_id")).alias("m"))
    keep = written(first.select(F.col("m.doc_id").alias("_kept"), F.col("m.mark").alias("_mark"), F.col("m.count").alias("_rows")), "simhash-kept")

    def meets(other: DataFrame) -> Column:
        return (docs["doc_id"] == other["_kept"]) & (mark == other["_mark"])

    once, again = keep.where("_rows = 1"), keep.where("_rows > 1")
    rest = docs.join(once, meets(once), "left_semi").unionByName(docs.where(docs["doc_id"].isNull()))
    if not again.limit(1).count():
        return rest
    repeated = docs.join(again, meets(again), "left_semi")
    return rest.unionByName(repeated.dropDuplicates(["doc_id", "text"]))
