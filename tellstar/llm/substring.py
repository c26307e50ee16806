"""Substring dedup: word windows that a document with a smaller doc_id also has.

Words are ``[^\\x20\\x09-\\x0D]+``. Every window of w words holds one whole block of w // 2
words of any non-overlapping block grid. So

1. each document's grid blocks are the index; every rolling block of every document probes it
   (32-bit hashes packed per task and hash bucket, so that a probe costs four bytes);
2. a probe that meets a block of a smaller doc_id, and the block it meets, are anchors: the
   windows around them are the candidates, extended word by word to their full length;
3. candidates are compared by 96-bit hashes of their words, smallest doc_id first; the windows
   seen before merge into maximal repeats, whose words are removed.

No step holds more than the distinct hashes of one bucket or the words of one chunk; copies
are never paired.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import PLAIN_WORD, Chunk, Words, each_in, map_chunks, record, rolling, texts

#: Least number of hash buckets; with more than four times as many input partitions, a quarter of
#: these (a bucket then has the hashes of four partitions' texts).
BUCKETS = 64
#: Hashes that a task packs together (a bucket's rows then grow with the tasks, not with the chunks).
PACKED = 1 << 21
#: Hashes that wait, at least, before they are sorted into those of a bucket that are held.
WAITING = 1 << 20
#: Rows of a batch that a task returns.
OUT_ROWS = 10_000
LOW = np.uint64(0xFFFFFFFF)


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary array whose values are consecutive runs of ``data``, ``sizes`` items each."""
    offsets = np.concatenate(([0], np.cumsum(sizes))) * data.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All items of a binary column as one array, and each value's number of items."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def bucketed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) % np.uint64(buckets)


def _blocks(words: Words, ids: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and place in it of every rolling block of documents with a window."""
    block = window // 2
    counts = words.counts()
    able = (counts >= window) & ~np.asarray(ids.is_null())
    sizes = np.where(able, counts - block + 1, 0)
    at = each_in(words.first[:-1], sizes)
    hashes = rolling(words.hashes(), block)[at] if len(at) else np.empty(0, np.uint64)
    return hashes, np.repeat(np.arange(len(sizes)), sizes), at - np.repeat(words.first[:-1], sizes)


def _packed(hashes: np.ndarray, doc: np.ndarray, ids: np.ndarray, buckets: int, kind: int) -> pa.RecordBatch:
    """One row for each bucket with rows: its documents, their numbers of hashes, the hashes."""
    bucket = bucketed(hashes, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 65536 else bucket, kind="stable")
    pair = bucket[order].astype(np.int64) * (len(ids) + 1) + doc[order]
    edge = np.flatnonzero(np.diff(pair, prepend=-1))
    sizes = np.diff(np.append(edge, len(pair)))
    of = pair[edge] // (len(ids) + 1)
    rows = np.flatnonzero(np.diff(of, prepend=-1))
    docs_in = np.diff(np.append(rows, len(of)))
    total = np.add.reduceat(sizes, rows) if len(rows) else rows
    return record(
        bucket=pa.array(of[rows], pa.int32()), kind=pa.array(np.full(len(rows), kind), pa.int32()),
        ids=binaries(ids[pair[edge] % (len(ids) + 1)], docs_in), counts=binaries(sizes.astype(np.int32), docs_in),
        keys=binaries((hashes[order] & LOW).astype(np.uint32), total))


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False)


def anchors(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """(doc_id, hits array<struct<bucket, keys>>): hashes of a document's blocks that meet an
    index block of a smaller doc_id, or that a larger one's blocks meet."""

    def packed_rows(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if held:
            hashes, doc, at, ids = map(np.concatenate, zip(*held))
            grid = at % (window // 2) == 0
            yield _packed(hashes[grid], doc[grid], ids, buckets, 0)
            fresh = np.ones(len(hashes), bool)  # a run of one block hash probes once
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            yield _packed(hashes[fresh], doc[fresh], ids, buckets, 1)

    def send(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        held, size, docs_held = [], 0, 0
        for part in parts:
            ids = part.column("doc_id")
            hashes, doc, at = _blocks(part.words(PLAIN_WORD), ids, window)
            if not len(hashes):
                continue
            held.append((hashes, doc + docs_held, at, _ids(ids)))
            size, docs_held = size + len(hashes), docs_held + len(part)
            if size >= PACKED:
                yield from packed_rows(held)
                held, size, docs_held = [], 0, 0
        yield from packed_rows(held)

    packed = map_chunks(texts(docs), send, "bucket int, kind int, ids binary, counts binary, keys binary")
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket", "kind")
    met = dealt.mapInArrow(_meet, "doc_id long, bucket int, keys binary")
    return met.groupBy("doc_id").agg(F.collect_list(F.struct("bucket", "keys")).alias("hits"))


def _lowest(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys[first], ids[first]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the index as each key's smallest doc_id, then the probes as they come."""
    bucket, held, waiting, sorted_in = None, [], 0, 0
    keys = lowest = shared = None

    def ended() -> Iterator[pa.RecordBatch]:
        if shared is not None and shared.any():
            yield _by_doc(bucket, lowest[shared], keys[shared])

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            b, kind = row.column("bucket")[0].as_py(), row.column("kind")[0].as_py()
            if b != bucket:
                yield from ended()
                bucket, held, waiting, sorted_in, keys, shared = b, [], 0, 0, None, None
            own = np.frombuffer(row.column("keys")[0].as_buffer(), np.uint32)
            ids = np.repeat(np.frombuffer(row.column("ids")[0].as_buffer(), np.int64), np.frombuffer(row.column("counts")[0].as_buffer(), np.int32))
            if kind == 0:
                held.append((own, ids))
                waiting += len(own)
                if waiting > max(WAITING, sorted_in):  # so that all sorts together stay near linear
                    held = [_lowest(*map(np.concatenate, zip(*held)))]
                    waiting, sorted_in = 0, len(held[0][0])
                continue
            if keys is None:
                keys, lowest = _lowest(*map(np.concatenate, zip(*held))) if held else (np.empty(0, np.uint32), np.empty(0, np.int64))
                shared, held = np.zeros(len(keys), bool), []
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = np.flatnonzero((keys[at] == own) & (ids > lowest[at]))
            if len(hit):
                shared[at[hit]] = True
                yield _by_doc(b, ids[hit], own[hit])
    yield from ended()


def _by_doc(bucket: int, ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(ids, kind="stable")
    ids, keys = ids[order], keys[order]
    edge = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return record(doc_id=ids[edge], bucket=pa.array(np.full(len(edge), bucket), pa.int32()), keys=binaries(keys, np.diff(np.append(edge, len(ids)))))


def candidates(joined: DataFrame, window: int, buckets: int, parts_out: int) -> DataFrame:
    """(part, doc_id, mark, keys, checks, places): the windows around a document's anchors."""
    block = window // 2

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("doc_id")
            words = part.words(PLAIN_WORD)
            hashes, doc, _ = _blocks(words, ids, window)
            key = bucketed(hashes, buckets) << np.uint64(32) | hashes & LOW
            lists = part.column("hits")
            bounds = np.asarray(lists.offsets)
            inner = lists.values
            held, sizes = flat(inner.field("keys"), np.uint32)
            held = held.astype(np.uint64) | np.repeat(inner.field("bucket").to_numpy(), sizes).astype(np.uint64) << np.uint64(32)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            first = np.searchsorted(doc, np.arange(len(part) + 1))
            places, of = [], []
            for i in range(len(part)):
                hit = np.isin(key[first[i]:first[i + 1]], held[ends[bounds[i]]:ends[bounds[i + 1]]])
                near = np.concatenate(([0], np.cumsum(hit)))
                n = len(hit) + block - window
                found = np.flatnonzero(near[window - block + 1:window - block + 1 + n] > near[:n]) if n > 0 else np.empty(0, np.int64)
                if len(found):
                    places.append(found)
                    of.append(np.full(len(found), i))
            if not places:
                continue
            place, of = np.concatenate(places), np.concatenate(of)
            at = words.first[of] + place
            full, check = (rolling(words.hashes(seed), window, seed)[at] for seed in (0, 1))
            pair = of * parts_out + (bucketed(check, parts_out)).astype(np.int64)
            order = np.argsort(pair, kind="stable")
            edge = np.flatnonzero(np.diff(pair[order], prepend=-1))
            sizes = np.diff(np.append(edge, len(pair)))
            rows = pair[order][edge]
            marks = np.array([zlib.crc32(part.bytes_of(i)) for i in range(len(part))], np.int64)
            yield record(
                part=pa.array(rows % parts_out, pa.int32()), doc_id=_ids(ids)[rows // parts_out], mark=marks[rows // parts_out],
                keys=binaries(full[order], sizes), checks=binaries((check[order] & LOW).astype(np.uint32), sizes),
                places=binaries(place[order].astype(np.int32), sizes))

    return map_chunks(joined, run, "part int, doc_id long, mark long, keys binary, checks binary, places binary")


def _seen_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (part, doc_id): the places whose window a smaller doc_id has.

    Windows wait until they are as many as the distinct ones held of their part (WAITING at
    least), so that what is held is sorted again only a few times, however many rows come."""
    now, held, waiting = None, [], 0
    none = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64)
    seen = none
    for batch in batches:
        part = batch.column("part").to_numpy()
        edge = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        for lo, hi in zip(edge[:-1], edge[1:]):
            if part[lo] != now:
                if held:
                    yield from _again(seen, held)[1]
                now, held, waiting, seen = part[lo], [], 0, none
            rows = batch.slice(lo, hi - lo)
            key, sizes = flat(rows.column("keys"), np.uint64)
            held.append((key, flat(rows.column("checks"), np.uint32)[0], flat(rows.column("places"), np.int32)[0], sizes,
                         rows.column("doc_id").to_numpy(), rows.column("mark").to_numpy()))
            waiting += len(key)
            if waiting >= max(WAITING, len(seen[0])):
                seen, found = _again(seen, held)
                yield from found
                held, waiting = [], 0
    if held:
        yield from _again(seen, held)[1]


def _again(seen: tuple[np.ndarray, ...], held: list[tuple[np.ndarray, ...]]) -> tuple[tuple[np.ndarray, ...], list[pa.RecordBatch]]:
    """``seen`` (windows with their smallest doc_id) with the windows of ``held`` (in order of doc_id,
    none smaller than those seen) in it, and the places of ``held`` whose window a smaller doc_id has."""
    key, check, place, sizes, doc_id, mark = map(np.concatenate, zip(*held))
    all_key, all_check, all_doc = (np.concatenate(x) for x in zip(seen, (key, check, np.repeat(doc_id, sizes))))
    order = np.lexsort((all_check, all_key))  # stable: equal windows stay in order of doc_id
    k, c, d = all_key[order], all_check[order], all_doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    again = np.zeros(len(k), bool)
    again[order] = d > d[new][np.cumsum(new) - 1]
    again = again[len(seen[0]):]
    rest = np.repeat(np.arange(len(sizes)), sizes)[again]
    if not len(rest):
        return (k[new], c[new], d[new]), []
    firsts = np.flatnonzero(np.diff(rest, prepend=-1))
    found = record(doc_id=doc_id[rest[firsts]], mark=mark[rest[firsts]], places=binaries(place[again], np.diff(np.append(firsts, len(rest)))))
    return (k[new], c[new], d[new]), [found.slice(at, OUT_ROWS) for at in range(0, found.num_rows, OUT_ROWS)]


def removals(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, text binary, found array<struct<mark, places>>): the first words of the windows
    to remove from each row with a doc_id, null where there are none. ``mark`` is the crc32 of
    the text that the places belong to (rows may repeat a doc_id with another text)."""
    buckets = parts = max(BUCKETS, docs.rdd.getNumPartitions() // 4)
    # the texts by doc_id are joined twice; with a name of its own for the key (which the optimiser
    # keeps as it is on both sides) the two joins share one exchange of the texts
    whole = texts(docs).where("doc_id is not null").select(F.col("doc_id").alias("text_id"), "text")
    met = anchors(docs, window, buckets)
    joined = whole.join(met, whole["text_id"] == met["doc_id"]).select(F.col("text_id").alias("doc_id"), "text", "hits")
    dealt = candidates(joined, window, buckets, parts).repartition("part").sortWithinPartitions("part", "doc_id")
    again = dealt.mapInArrow(_seen_before, "doc_id long, mark long, places binary")
    found = again.groupBy("doc_id").agg(F.collect_list(F.struct("mark", "places")).alias("found"))
    return whole.join(found, whole["text_id"] == found["doc_id"], "left").select(F.col("text_id").alias("doc_id"), "text", "found")


def removed_words(part: Chunk, words: Words, window: int) -> np.ndarray:
    """True for every word of the chunk that a window to remove covers."""
    step = np.zeros(len(words) + 1, np.int64)
    found = part.column("found")
    for i in np.flatnonzero(np.asarray(found.is_valid())).tolist():
        mark = zlib.crc32(part.bytes_of(i))
        for entry in found[i].as_py():
            if entry["mark"] == mark:
                at = words.first[i] + np.frombuffer(entry["places"], np.int32)
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
    return np.cumsum(step[:-1]) > 0


def report(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans array<struct<start, stop>>) for every row.

    A word goes if a window of ``window`` words covers it that also starts in a document with a
    smaller doc_id; all windows are those of the input. ``spans`` are the removed runs (maximal
    repeats) as word numbers. A null text has no words; fewer words than a window lose none; a
    row without doc_id is neither smaller nor larger than any and stays whole.
    """

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = part.words(PLAIN_WORD)
            gone = removed_words(part, words, window)
            shas, spans, lost = [], [], []
            for i in range(len(part)):
                own = part.bytes_of(i).split()
                flags = gone[words.first[i]:words.first[i + 1]]
                pairs = []
                if flags.any():
                    step = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
                    pairs = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
                    own = [own[j] for j in np.flatnonzero(~flags).tolist()]
                lost.append(sum(b - a for a, b in pairs))
                spans.append([{"start": a, "stop": b} for a, b in pairs])
                shas.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield record(doc_id=part.column("doc_id"), n_words=words.counts().astype(np.int64), n_removed=np.array(lost, np.int64), kept_sha256=pa.array(shas, pa.string()),
                         spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,stop:long>>"
    return map_chunks(_with_unnamed(docs, removals(docs, window)), run, schema)


def _with_unnamed(docs: DataFrame, found: DataFrame) -> DataFrame:
    unnamed = texts(docs).where("doc_id is null").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    return found.unionByName(unnamed)


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with the repeated words cut out of the texts (what stays keeps its own white
    space). ``n_chars``, if there, is the new text's number of characters where words were
    cut; documents that lose their last word go, documents that lose none are unchanged."""

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = part.words(PLAIN_WORD)
            gone = removed_words(part, words, window)
            ids, marks, cut = [], [], []
            for i in np.flatnonzero(np.asarray(part.column("found").is_valid())).tolist():
                flags = gone[words.first[i]:words.first[i + 1]]
                if flags.any():
                    ids.append(part.column("doc_id")[i].as_py())
                    marks.append(zlib.crc32(part.bytes_of(i)))
                    cut.append(_cut(part, words, i, flags))
            yield record(_doc=pa.array(ids, pa.int64()), _mark=pa.array(marks, pa.int64()), _new=pa.array(cut, pa.binary()))

    changed = map_chunks(removals(docs, window).where("found is not null"), run, "_doc long, _mark long, _new binary").dropDuplicates(["_doc", "_mark"])
    marked = docs.withColumn("_crc", F.crc32(F.col("text").cast("string").cast("binary")))
    both = marked.join(changed, (marked["doc_id"] == changed["_doc"]) & (marked["_crc"] == changed["_mark"]), "left")
    kept = both.where(F.col("_doc").isNull() | (F.octet_length("_new") > 0))
    new = F.col("_new").cast("string")
    out = {"text": F.coalesce(new, docs["text"])}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(new.isNotNull(), F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(docs["n_chars"])
    return kept.select(*[out[c].alias(c) if c in out else docs[f"`{c}`"] for c in docs.columns])


def _cut(part: Chunk, words: Words, i: int, flags: np.ndarray) -> bytes:
    """Document i without its flagged words and the white space before each of them."""
    lo, hi = words.first[i], words.first[i + 1]
    if flags.all():
        return b""
    drop = np.zeros(part.bounds[i + 1] - part.bounds[i] + 1, np.int64)
    base = part.bounds[i]
    before = np.concatenate(([base], words.end[lo:hi][:-1]))
    np.add.at(drop, before[flags] - base, 1)
    np.add.at(drop, words.end[lo:hi][flags] - base, -1)
    return part.data[base:part.bounds[i + 1]][np.cumsum(drop[:-1]) == 0].tobytes()
