import zlib

import numpy as np
import pytest

from tellstar.llm import quality, toxicity
from tellstar.llm.queries import op2_quality, op6_toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query,column,least", [(op2_quality, "quality", 0.99), (op6_toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, query, column, least):
    rows = query(spark, SF).collect()
    label = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= (0.3 if column == "quality" else 0.5)) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and label.get(r.doc_id) is not None]
    assert sum(p == y for p, y in held) / len(held) >= least


def test_additive_model_learns_tables_and_a_pair():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(4000, len(quality.FEATURES))).astype(np.float32)
    truth = 2 * (rows[:, 0] > 0.5) - 2 * (rows[:, 3] < -1) + 3 * ((rows[:, 5] > 0) ^ (rows[:, 7] > 0)) - 1.5
    label = (rng.random(4000) < 1 / (1 + np.exp(-truth))).astype(float)
    model = quality.fit(rows, label)
    assert (5, 7) in [(i, j) for i, j, *_ in model.pairs]
    assert np.corrcoef(model.margin(rows), truth)[0, 1] > 0.9
    whole = model.base + sum(t[b] for t, b in zip(model.tables, model.bins(rows)))
    whole += sum(t[np.searchsorted(a, rows[:, i], side="right"), np.searchsorted(b, rows[:, j], side="right")] for i, j, a, b, t in model.pairs)
    assert np.allclose(whole, model.margin(rows))
    assert quality.fit(rows[:0], label[:0]).score(rows[:3]).tolist() == pytest.approx([0.5] * 3)


def test_label_model_weighs_accuracy_and_copies():
    rng = np.random.default_rng(2)
    truth = rng.random(5000) < 0.3
    good = [np.where(rng.random(5000) < 0.9, truth, ~truth) for _ in range(4)]
    noise = rng.random(5000) < 0.5
    votes = np.stack([*good, *[np.where(rng.random(5000) < 0.97, noise, ~noise) for _ in range(8)]], axis=1).astype(np.int8)
    noisy = np.where(rng.random(5000) < 0.85, truth, ~truth).astype(float)
    found = toxicity.label_model(votes, 0.3, noisy) > 0.5
    assert (found == truth).mean() > 0.95


def test_label_model_counts_a_row_of_force_n_like_n_rows():
    rng = np.random.default_rng(4)
    votes, label = (rng.random((300, 6)) < 0.3).astype(np.int8), (rng.random(300) < 0.4).astype(float)
    force = np.where(label == 1, 1, 3)
    copies = np.repeat(np.arange(300), force)
    assert toxicity.label_model(votes, 0.2, label, force=force) == pytest.approx(toxicity.label_model(votes[copies], 0.2, label[copies])[np.cumsum(force) - 1])


def test_prior_is_the_labels_share_at_any_sample_size(spark, monkeypatch):
    seen = []
    real = toxicity.label_model
    monkeypatch.setattr(toxicity, "label_model", lambda votes, prior, label, **more: seen.append((prior, label, more)) or real(votes, prior, label, **more))
    docs = spark.createDataFrame([(i, f"text {i} " + ("idiot" if i % 5 == 0 else "cat")) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    toxicity.train(docs, labels, per_class=20)
    (whole, every, _), (prior, label, more) = seen
    assert prior == whole == pytest.approx((every.sum() + 0.5) / (len(every) + 1))
    assert len(label) == 40 and [more["force"][label == y].sum() for y in (0, 1)] == pytest.approx([(every == y).sum() for y in (0, 1)])


@pytest.mark.parametrize("scores", [quality.scores, toxicity.scores])
def test_edge_cases(spark, scores):
    rows = [(None, "no id"), (1, None), (2, ""), (3, " \n"), (4, "one"), (4, "One TWO!! |"), (5, "é" * 30000), (6, "word " * 20000)]
    docs = spark.createDataFrame([(d, t, 9, "x") for d, t in rows], "doc_id long, text string, label int, held_out string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 1), (6, None, None), (None, 1, 1), (3, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = scores(docs, known).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in rows)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert scores(docs.limit(0), labels).count() == 0


def test_accepted_keeps_rows_unchanged(spark):
    clean = ["the cat sat on the mat number %d" % i for i in range(60)]
    docs = [(i, t, "s", None) for i, t in enumerate(clean)] + [(100 + i, f"you are a stupid idiot {i} moron", "s", i) for i in range(60)] + [(200, None, None, 1), (None, "a cat", "s", 2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, weight int")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in [*range(60), *range(100, 160)]], "doc_id long, toxic int")
    kept = toxicity.accepted(frame, labels)
    assert kept.columns == frame.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in frame.collect() if r.doc_id is None or r.doc_id < 100 or r.doc_id == 200)
