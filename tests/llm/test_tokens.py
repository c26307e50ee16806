import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tellstar.llm import bpe, packing
from tellstar.llm.bpe import Counter, Merges, token_counts
from tellstar.llm.text import chunks
from tellstar.llm.queries import op4_packing, op10_token_counts

SF = "/root/testdata/sf0.01"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
byte_library, word_library = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
counter, ids = Counter(Merges(BYTE)), packing.Ids(WORD)
ODD = ["", " ", "\n\n  x", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|startoftext|>Hi", "don't we'LL I'm 's", "  a b  ", "\x1c\x1d x\x1f y", "\u0085 q 　z​z",
       "aaaaaaaaaaaaaaa" * 40, "x" * 3001, " " * 3000 + "end", "é ́a ﬁ ΣΑΣ", "日本語のテキスト ١٢٣ ½ Ⅷ", "\U0001f600\U0001f468‍\U0001f469 ok", "\t\r\n\x0b\x0c", "1234567890" * 30, "<|STARTOFTEXT|> x", "a.b,c!d--e's.'t x're'", "≮ ≮ .́ a.́b é.é—.x", "a\x00b", "İstanbul ǅ ß"]


def ids_by_operator(texts):
    part = next(chunks([pa.RecordBatch.from_pydict({"text": pa.array([t.encode() for t in texts], pa.binary())})], 1 << 30))
    return ids.of(part, 2)


def test_odd_texts():
    assert counter.counts(ODD) == [len(byte_library.encode(t, add_special_tokens=False).ids) for t in ODD]
    for text, own in zip(ODD, ids_by_operator(ODD)):
        assert own.tolist() == [*word_library.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdlret.,aAbe ́é1½中<|>"), st.characters(exclude_categories=["Cs", "Cn", "Co"])), max_size=60))
def test_any_text(text):
    assert counter.counts([text]) == [len(byte_library.encode(text, add_special_tokens=False).ids)]
    assert ids_by_operator([text])[0].tolist() == [*word_library.encode(text, add_special_tokens=False).ids, 2]


def test_more_units_than_are_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    small = Counter(Merges(BYTE))
    texts = [["a b"], [" ".join(f"id{i}x" for i in range(40))], ["a", "c d e f", ""], ["k l m n o p q r"], ["a b"], [""], []]
    for batch in texts:
        assert small.counts(batch) == [len(byte_library.encode(t, add_special_tokens=False).ids) for t in batch]
    assert Counter(Merges(BYTE)).counts(texts[1]) == small.counts(texts[1])


def test_counts_equal_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in op10_token_counts(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        n = len(byte_library.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id] == (r.doc_id, len((r.text or "").encode()), n, n > 1024)


def check_pieces(rows, docs, capacity=4096):
    """Gapless sequences, every id in one piece; returns the share of padding."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for name, text in docs:
        want = np.array([*word_library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(of_doc.pop(name), key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(want[at:at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    assert not of_doc
    tokens = padding = 0
    for pieces in of_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        tokens += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(1, tokens)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check_pieces(op4_packing(spark, SF).collect(), docs) < 0.005


def test_differencing_is_near_equal():
    rng = np.random.default_rng(3)
    sizes = np.minimum(rng.lognormal(6, 1, 2000).astype(int) + 1, 1024)
    k = 200
    sums = np.bincount(packing.differencing(sizes, k), sizes, minlength=k)
    assert sums.sum() == sizes.sum() and sums.max() - sums.mean() <= 16
    assert packing.differencing(np.array([8, 7, 6, 5, 4]), 2).tolist() in ([0, 1, 1, 0, 0], [1, 0, 0, 1, 1], [0, 1, 0, 1, 1], [1, 0, 1, 0, 0], [0, 1, 1, 0, 1], [1, 0, 0, 1, 0])
    found = packing.windows(np.array([3, 3, 3, 3]), 5)
    assert sorted(found.tolist()) == [0, 1, 2, 3]


def test_edge_cases(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["a", "bee", "of"]) for _ in range(rng.choice([0, 3, 4096, 5000, 9000])))) for i in range(12)] + [(20, None), (21, ""), (22, "x" * 20000)]
    frame = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, start int, ids string").repartition(3)
    rows = packing.pack(frame, WORD).collect()
    assert check_pieces(rows, docs) < 0.005
    assert all(len(r.ids) == r.length for r in rows)
    twice = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in packing.pack(twice, WORD).groupBy("doc_id").sum("length").collect()) == ["1", "None"]
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts(twice, BYTE).collect()) == [("1", 2), ("1", 2), ("None", 2)]
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(frame, BYTE).collect()}[20] == (0, 0)
    assert packing.pack(frame.limit(0), WORD).count() == token_counts(frame.limit(0), BYTE).count() == 0
