"""Byte-level BPE token counts by rank-synchronous merging of ragged numpy arrays.

A text is cut into units (a run without white space and one blank before it, or a run of white
space); all pre-tokens lie inside units. The pre-tokens of the units a task has not met yet are
held as one ragged array of symbols, and in each round every sequence merges all occurrences
of its lowest-ranked pair at once, until no pair is left; the symbols that survive are its tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Chunk, each_in, map_chunks, record, texts

#: Fixed value: the characters that ``\\s`` stands for in the pre-tokenizer's pattern.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNITS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Fixed value: the public byte-level pattern.
PIECES = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{SPACE}\\p{{L}}\\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
NONE = np.int64(1) << 40
#: Units remembered by a task; the memory is emptied before a chunk that would pass this number
#: (all units of one chunk are held, however many they are).
REMEMBERED = 400_000


class Merges:
    """Merge ranks of a tokenizer file (byte-level BPE without normaliser)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left, right, whole = (np.array([vocabulary[x] for x in column], np.int64) for column in
                              ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        self.size = len(vocabulary) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        first = np.concatenate(([True], np.diff(keys[order]) != 0))
        self.keys, self.ranks = keys[order][first], order[first]
        self.whole = whole
        self.bytes = np.array([vocabulary[c] for c in _byte_characters()], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece (bytes, not empty)."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbol = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        out, name = np.ones(len(pieces), np.int64), np.arange(len(pieces))
        rank = np.full(len(symbol), NONE)  # of the pair that begins here
        rank[:-1] = self.rank(symbol[:-1], symbol[1:])
        rank[np.cumsum(sizes) - 1] = NONE
        while len(name):
            first = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, first)
            live = lowest < NONE
            out[name[~live]] = sizes[~live]
            if not live.all():
                kept = each_in(first[live], sizes[live])
                symbol, rank = symbol[kept], rank[kept]
                name, sizes, lowest = name[live], sizes[live], lowest[live]
                if not len(name):
                    break
            of = np.repeat(np.arange(len(sizes)), sizes)
            chosen = rank == lowest[of]
            start = chosen.copy()
            start[1:] &= ~chosen[:-1]
            runs = np.flatnonzero(start)
            at = np.flatnonzero(chosen)
            since = at - runs[np.searchsorted(runs, at, side="right") - 1]
            at = at[since % 2 == 0]  # of overlapping pairs (a run of one symbol) every other one
            symbol[at] = self.whole[rank[at]]
            gone = np.zeros(len(symbol), bool)
            gone[at + 1] = True
            rank[at] = rank[at + 1]  # NONE where the sequence ends
            sizes -= np.bincount(of[at], minlength=len(sizes))
            fresh = np.zeros(len(symbol), bool)
            fresh[at] = True
            symbol, rank, fresh = symbol[~gone], rank[~gone], fresh[~gone]
            last = np.zeros(len(symbol), bool)
            last[np.cumsum(sizes) - 1] = True
            redo = fresh.copy()
            redo[:-1] |= fresh[1:]
            redo = np.flatnonzero(redo & ~last)
            rank[redo] = self.rank(symbol[redo], symbol[redo + 1])
            rank[last] = NONE
        return out


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Counter:
    """Token counts of texts; remembers units."""

    def __init__(self, merges: Merges):
        self.merges, self.known = merges, {}

    def _learn(self, units: set[str]) -> None:
        pieces, sizes, units = [], [], list(units)
        for unit in units:
            found = PIECES.findall(unit)
            sizes.append(len(found))
            pieces += found
        distinct = list(set(pieces))
        tokens = dict(zip(distinct, self.merges.counts([p.encode("utf-8", "surrogatepass") for p in distinct]).tolist())) if distinct else {}
        ends = np.concatenate(([0], np.cumsum([tokens[p] for p in pieces])))
        at = np.concatenate(([0], np.cumsum(sizes)))
        self.known.update(zip(units, (ends[at[1:]] - ends[at[:-1]]).tolist()))

    def counts(self, batch: list[str]) -> list[int]:
        split = self.merges.split
        cut = [split.split(t) if split is not None else [t] for t in batch]
        units = [[u for part in parts for u in UNITS.findall(part)] for parts in cut]
        all_units = set().union(*units)
        new = all_units.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = all_units
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [sum(map(get, u)) + len(parts) - 1 for u, parts in zip(units, cut)]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, in the input's partitions.

    Tokens of the whole text as the tokenizer file's own library counts them, without begin or
    end; a special token's string in the text is that one token. A null or empty text has 0.
    ``tokenizer`` is a path that every executor can open."""

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Merges(tokenizer))
        for part in parts:
            n = np.array(counter.counts([part.bytes_of(i).decode("utf-8", "replace") for i in range(len(part))]), np.int64)
            yield record(doc_id=part.column("doc_id"), n_bytes=np.diff(part.bounds), n_tokens=n, over_limit=n > limit)

    return map_chunks(texts(docs), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
