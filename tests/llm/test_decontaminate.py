import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tellstar.llm import decontaminate
from tellstar.llm.fmindex import FmIndex
from tellstar.llm.queries import op9_decontamination

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13, share=20):
    phrases = {}
    for name, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(str(name))
    sizes = sorted({len(p) for p in phrases})
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (names := phrases.get(tuple(w[i:i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= names
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and share * len(hit) >= len(w), hit))
    return out


def test_query_equals_brute_force(spark):
    got = sorted(tuple(r) for r in op9_decontamination(spark, SF).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got == [r[:6] for r in brute(docs, items)]
    assert any(r[5] for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.lists(st.lists(st.integers(2, 3), min_size=1, max_size=5), min_size=1, max_size=6))
def test_index_finds_every_occurrence(text, patterns):
    seq = np.array(text + [0])
    rows = np.zeros((len(patterns), 5), np.int64)
    for i, p in enumerate(patterns):
        rows[i, 5 - len(p):] = p
    index = FmIndex(seq, 4, sample=4)
    lo, hi = index.search(rows, np.array([len(p) for p in patterns]))
    which, at = index.locate(lo, hi)
    want = sorted((i, j) for i, p in enumerate(patterns) for j in range(len(text) - len(p) + 1) if text[j:j + len(p)] == p)
    assert sorted(zip(which.tolist(), at.tolist())) == want


def test_edge_cases_blocks_and_clean(spark, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = [(1, None), (2, ""), (3, "-- !!"), (4, passage), (4, passage), (5, "x " * 500 + passage), (6, "one two"), (7, "ONE, two three"),
            (8, " ".join(["a"] * 40)), (None, passage + " tail"), (9, "filler " * 30000)]
    items = [(10, passage), (11, passage), (11, passage), (2, "one two"), (30, None), (31, " "), (None, "filler filler"), (32, " ".join(["a"] * 14))]
    frame = spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(docs)], "doc_id long, text string, n_words int, spans string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, hit int")
    want = brute(docs, [x for x in items if x[0] is not None])
    key = lambda r: (r[0] is None, r[0] or 0)
    for limit in (1 << 20, 60):
        monkeypatch.setattr(decontaminate.blocks, "__defaults__", (limit,))
        got = sorted(decontaminate.report(frame, bench).collect(), key=key)
        assert [tuple(r)[:6] for r in got] == [w[:6] for w in sorted(want, key=key)]
        assert [{i for s in r.spans for i in range(s.start, s.stop)} for r in got] == [w[6] for w in sorted(want, key=key)]
    kept = decontaminate.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted((r.n_words, r.text) for r in kept.collect()) == [(i, docs[i][1]) for i, w in enumerate(want) if not w[5]]
    assert decontaminate.report(frame.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontaminate.report(frame, bench.limit(0)).collect()} == {0}
