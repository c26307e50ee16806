"""The quality model's numbers and trees against plain loops."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tellstar.llm import quality
from tellstar.llm.queries import op2_quality

SF = "/root/testdata/sf0.001"
SYMBOLS = set(b"#$%&*+<=>@^_`~")


def plain(text: str | None) -> dict[str, float]:
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [sorted(w) for w in (re.findall(rb"[^\x20\x09-\x0D]+", x) for x in data.split(b"\n")) if w]
    pairs = list(zip(words, words[1:]))
    longest = max((len(m.group(0)) for m in re.finditer(rb"(.)\1*", data, re.S)), default=0)

    def share(items, test):
        items = list(items)
        return sum(map(bool, map(test, items))) / max(len(items), 1)

    def most(items):
        return max(Counter(items).values(), default=0) / max(len(items), 1)

    return {
        "log_bytes": math.log1p(len(data)), "log_words": math.log1p(len(words)), "word_length": sum(map(len, words)) / max(len(words), 1),
        "long_words": share(words, lambda w: len(w) > 12), "upper": share(data, lambda c: 65 <= c <= 90), "digits": share(data, lambda c: 48 <= c <= 57),
        "punctuation": share(data, lambda c: c < 128 and chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), "other_bytes": share(data, lambda c: c > 127),
        "blanks": share(data, lambda c: c == 32), "newlines": share(data, lambda c: c == 10),
        "distinct_words": len(set(words)) / max(len(words), 1), "top_word": most(words), "distinct_pairs": len(set(pairs)) / max(len(pairs), 1), "top_pair": most(pairs),
        "same_as_before": sum(a == b for a, b in pairs) / max(len(words), 1), "line_words": len(words) / max(len(lines), 1),
        "distinct_lines": len({tuple(x) for x in lines}) / max(len(lines), 1), "short_lines": share(lines, lambda x: len(x) < 4),
        "bangs": share(data, lambda c: c == 33), "bars": share(data, lambda c: c == 124), "symbols": share(data, lambda c: c in SYMBOLS),
        "marked_ends": share(words, lambda w: w[-1] in SYMBOLS or w[-1] == 33), "capital_starts": share(words, lambda w: 65 <= w[0] <= 90),
        "longest_run": math.log1p(longest)}


def assert_plain(rows, text):
    for r in rows:
        want = plain(text[r.doc_id])
        assert dict(zip(quality.FEATURES, r.features)) == pytest.approx({k: want[k] for k in quality.FEATURES}, rel=1e-5, abs=1e-6), r.doc_id


def test_numbers_of_whole_texts_equal_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = quality.described(docs).collect()
    assert len(rows) == len(text) >= 100
    assert_plain(rows, text)


def test_numbers_of_odd_texts_equal_plain_loops(spark):
    texts = [None, "", " \t\n", "a", "A!", "x\n\nx\ny x\nx y", "one one\x0bone\rONE one", "é" * 5000, "ab " * 40000, "!!!!| ||~", "\n".join(["same line here"] * 50), "z" * 70000 + " end"]
    text = dict(enumerate(texts))
    rows = quality.described(spark.createDataFrame(list(text.items()), "doc_id long, text string").coalesce(1)).collect()
    assert len(rows) == len(texts)
    assert_plain(rows, text)


def test_query_adds_up_the_tables_of_its_model(spark, monkeypatch):
    models = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: models.append(real(*a, **k)) or models[-1])
    rows = op2_quality(spark, SF).collect()
    model, = models
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        x = np.array([plain(text[r.doc_id])[k] for k in quality.FEATURES], np.float32)
        margin = model.base + sum(t[sum(v >= e for e in edges)] for v, edges, t in zip(x, model.edges, model.tables))
        margin += sum(t[sum(x[i] >= e for e in a), sum(x[j] >= e for e in b)] for i, j, a, b, t in model.pairs)
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, margin)))), abs=0.02)


def test_split_is_the_best_of_all_cuts():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 31):
        g, h = rng.normal(size=size), rng.random(size) * 4
        gains = {c: g[:c].sum() ** 2 / (h[:c].sum() + 1.5) + g[c:].sum() ** 2 / (h[c:].sum() + 1.5) - g.sum() ** 2 / (h.sum() + 1.5)
                 for c in range(1, size) if h[:c].sum() >= 2 and h[c:].sum() >= 2}
        gain, cut = quality._split(g, h, 2, 1.5)
        if gains:
            assert gain == pytest.approx(max(gains.values())) and gains[cut] == pytest.approx(gain)
        else:
            assert cut == 0
