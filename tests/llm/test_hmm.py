import collections
import itertools
import math
import zlib

import numpy as np
import pytest

from tellstar.llm import hmm
from tellstar.llm.queries import op3_hmm

SF = "/root/testdata/sf0.01"


def tokens_of(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() + [None]


def held(doc):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 10 == 0


def brute_base(docs):
    c = collections.Counter(t for d, x in docs if not held(d) for t in tokens_of(x))
    n, v = sum(c.values()), len(c)
    return [(d, held(d), len(tokens_of(x)), sum(c[t] > 0 for t in tokens_of(x)), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens_of(x))) for d, x in docs]


def test_query_base_scores_and_gain(spark):
    rows = sorted(op3_hmm(spark, SF).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = brute_base(docs)
    assert [tuple(r)[:5] for r in rows] == [w[:5] for w in want]
    assert [r.base_score for r in rows] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    for out in (True, False):
        assert sum(r.score for r in rows if r.held_out == out) > sum(r.base_score for r in rows if r.held_out == out)


def random_model(rng, symbols, k=3):
    unit = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(unit(rng.random(k), 0), unit(rng.random((k, k)), 1), unit(rng.random((symbols, k)), 0))


def test_forward_equals_sum_over_paths_and_expected_counts():
    rng = np.random.default_rng(1)
    model = random_model(rng, 4)
    texts = [rng.integers(0, 4, n) for n in (1, 5, 3, 5)]
    symbol, size = np.concatenate(texts), np.array([len(t) for t in texts])
    first = np.cumsum(size) - size
    logs, start, steps, shown = [], np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for text in texts:
        total, s, st, sh = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
        for path in itertools.product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.shown[text[0], path[0]]
            for t in range(1, len(text)):
                p *= model.step[path[t - 1], path[t]] * model.shown[text[t], path[t]]
            total += p
            s[path[0]] += p
            for t, x in enumerate(text):
                sh[x, path[t]] += p
                if t:
                    st[path[t - 1], path[t]] += p
        logs.append(math.log10(total))
        start, steps, shown = start + s / total, steps + st / total, shown + sh / total
    assert hmm.forward(model, symbol, first, size) == pytest.approx(logs)
    got = hmm.expected(model, symbol, first, size)
    for a, b in zip(got, (start, steps, shown)):
        assert np.allclose(a, b, rtol=1e-5, atol=1e-6)


def plain_counts(model, texts):
    """Expected counts by double-precision recursions over one text after the other."""
    k = len(model.start)
    start, steps, shown = np.zeros(k), np.zeros((k, k)), np.zeros(model.shown.shape)
    for text in texts:
        e = model.shown[text]
        alpha, beta = np.zeros((len(text), k)), np.ones((len(text), k))
        for t in range(len(text)):
            alpha[t] = e[t] * (model.start if t == 0 else alpha[t - 1] @ model.step)
            alpha[t] /= alpha[t].sum()
        for t in range(len(text) - 2, -1, -1):
            beta[t] = model.step @ (e[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
            pair = alpha[t][:, None] * model.step * (e[t + 1] * beta[t + 1])
            steps += pair / pair.sum()
        post = alpha * beta
        post /= post.sum(axis=1, keepdims=True)
        start += post[0]
        np.add.at(shown, text, post)
    return start, steps, shown


@pytest.mark.parametrize("together", [1_000_000, 900, 40])
def test_counts_of_long_texts_in_any_blocks(monkeypatch, together):
    """Texts of thousands of tokens are one sequence, also where a block of steps ends in them;
    emissions differ by many orders of magnitude between states."""
    monkeypatch.setattr(hmm, "BLOCK", together)
    rng = np.random.default_rng(together)
    model = random_model(rng, 50, 8)
    model.shown = rng.random((50, 8)) ** 12 + 1e-9
    model.shown /= model.shown.sum(axis=0)
    model.step = 0.97 * np.eye(8) + 0.03 * model.step
    texts = [rng.integers(0, 50, n) for n in (1, 700, 3000, 2, 700, 255, 256, 257, 1, 513)]
    size = np.array([len(t) for t in texts])
    got = hmm.expected(model, np.concatenate(texts).astype(np.int32), np.cumsum(size) - size, size)
    for a, b in zip(got, plain_counts(model, texts)):
        assert np.allclose(a, b, rtol=2e-4, atol=2e-3)
    assert got[0].sum() == pytest.approx(10, rel=1e-5) and got[1].sum() == pytest.approx((size - 1).sum(), rel=1e-5) and got[2].sum() == pytest.approx(size.sum(), rel=1e-5)


def test_score_is_the_model_s_probability_of_the_text(spark, monkeypatch):
    """Shares of all words, known or not, sum to one after any beginning: scored by brute force."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choice(vocabulary[:10] if i % 2 else vocabulary[8:], rng.integers(1, 40)))) for i in range(80)] + [(None, "new words"), (900, None), (901, " "), (7, "W1 w2"), (902, "x " * 3000)]
    frame = spark.createDataFrame([(d, t, 1, 2.0) for d, t in docs], "doc_id long, text string, row int, score double").repartition(3)
    seen = []
    real = hmm.trained
    monkeypatch.setattr(hmm, "trained", lambda d, w, r: seen.append((w, real(d, w, r))) or seen[-1][1])
    got = sorted((tuple(r) for r in hmm.scores(frame, rounds=(2, 1), limit=6).collect()), key=str)
    want = brute_base(docs)
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want, key=str)]
    words, model = seen[0]
    count = collections.Counter(t for d, x in docs if not held(d) for t in tokens_of(x))
    by_hash = lambda w: hmm.Tokens(next(hmm_chunk(w)))
    for g, (d, text) in zip(got, sorted(docs, key=lambda r: str(next(w for w in want if w[0] == r[0] and w[2] == len(tokens_of(r[1])))))):
        alpha, log = model.start, 0.0
        for i, t in enumerate(tokens_of(text)):
            alpha = alpha if i == 0 else alpha @ model.step
            if t is None:
                p = model.shown[0]
            else:
                symbol, place = words.lookup(by_hash(t))
                p = model.shown[symbol[0]]
                if place[0] < 0:
                    kind = symbol[0] - 1 - len(words.keys)
                    p = p * (count[t] + 0.1) / (words.class_tokens[kind] + 0.1 * (words.class_words[kind] + 1))
            alpha = alpha * p
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert g[6] == pytest.approx(log, rel=1e-6, abs=1e-5)
    assert 0 < len(words.keys) <= 6


def test_training_is_over_all_documents(spark, monkeypatch):
    """A kind of text found only in the last few documents (by hash) still shapes a state."""
    assert set(hmm.ROUNDS) == {1}
    ids = [r.id for r in spark.sql("select id from range(5000) where crc32(cast(cast(id as string) as binary)) % 10 <> 0 order by xxhash64(id)").collect()]
    rng = np.random.default_rng(5)
    common, rare = [f"w{i}" for i in range(40)], [f"r{i}" for i in range(20)]
    docs = [(d, " ".join(rng.choice(rare if at >= len(ids) - 5 else common, 60))) for at, d in enumerate(ids)]
    seen = []
    real = hmm.first_model
    monkeypatch.setattr(hmm, "first_model", lambda t, w: seen.append((w, real(t, w))) or seen[-1][1])
    hmm.scores(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), rounds=()).count()
    words, model = seen[0]
    at = [words.lookup(hmm.Tokens(next(hmm_chunk(w))))[0][0] for w in rare]
    assert model.shown[at].sum(axis=0).max() > 100 * words.unigram()[at].sum()


def hmm_chunk(word):
    import pyarrow as pa

    from tellstar.llm.text import chunks
    return chunks([pa.RecordBatch.from_pydict({"text": pa.array([word], pa.binary())})])


def test_empty_and_untrained(spark):
    frame = spark.createDataFrame([(d, "a b") for d in range(200) if held(d)] + [(4, None)][:0], "doc_id long, text string")
    rows = hmm.scores(frame, rounds=(1,)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in rows} == {(0, 0, 0.0)}
    assert hmm.scores(frame.limit(0), rounds=(1,)).count() == 0
