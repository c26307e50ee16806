import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellstar.llm import neighbours
from tellstar.llm.queries import op13_neighbours

SF = "/root/testdata/sf0.001"


def brute(rows, is_query, k=20):
    v = [(i, [float(x) for x in e]) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    with np.errstate(all="ignore"):
        by_dim = {d: (np.array([i for i, e in v if len(e) == d]), np.array([e for _, e in v if len(e) == d])) for d in {len(e) for _, e in v}}
        out = []
        for q, e in {i: e for i, e in sorted(v, reverse=True) if is_query(i)}.items():
            ids, m = by_dim[len(e)]
            scores = (np.array(e) * m).sum(axis=1)
            scores[np.isnan(scores)] = -np.inf
            found = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def reached(got, want):
    least = {q: s for q, _, _, s in want}
    return sum(s >= least[q] - 1e-9 for q, _, _, s in got) / len(want)


def test_query_reaches_the_nearest(spark):
    got = sorted(tuple(r) for r in op13_neighbours(spark, SF).collect())
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in frame.collect()}
    want = brute(rows.items(), lambda i: i % 20 == 0)
    assert [r[:2] for r in got] == [r[:2] for r in want] and reached(got, want) >= 0.95
    assert len({(q, i) for q, _, i, _ in got}) == len(got) and all(q != i for q, _, i, _ in got)
    for q, _, i, s in got:
        assert s == pytest.approx(float(np.dot(np.array(rows[q], float), np.array(rows[i], float))), abs=1e-12)
    assert all(a[3] > b[3] or (a[3] == b[3] and a[2] < b[2]) for a, b in zip(got, got[1:]) if a[0] == b[0])
    measured = neighbours.recall(spark.createDataFrame(got, "query_id long, rank int, vec_id long, score double"), frame, F.col("vec_id") % 20 == 0)
    assert measured == pytest.approx(reached(got, want))


def test_small_shards_are_exact_with_copies_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=6) * (1 + i % 4)).tolist()) for i in range(300)] + [(1000 + i, rows_ := [2.0, 0.0, -1.0, 0.5, 0.0, 0.0]) for i in range(150)]
    rows += [(2000, None), (2010, [1.0, None]), (2020, [0.0] * 6), (2030, [float("nan")] * 6), (2040, [float("inf")] * 6), (None, [1.0] * 6), (2050, []),
             (2060, [1.0, 2.0]), (2061, [2.0, 1.0]), (2062, [-0.0, -3.0]), (2070, [4.0]), (2080, [1e300, -1e300, 1e300, 0.0, 0.0, 1.0]), (2081, [1e-300] * 6), (2082, [1e300] * 6)]
    rows += [(20, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (1010, rows_), (1010, rows_)] + [(5, rows[5][1])] * 4
    frame = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, rank long").repartition(3)
    want = brute(rows, lambda i: i % 10 == 0)
    for size in (8 << 20, 900):
        monkeypatch.setattr(neighbours, "BLOCK_BYTES", size)
        got = neighbours.search(frame, F.col("vec_id") % 10 == 0, shard_rows=30)
        rows_ = sorted(tuple(r) for r in got.collect())
        assert [r[:3] for r in rows_] == [r[:3] for r in want]
        assert [r[3] for r in rows_] == pytest.approx([r[3] for r in want], rel=1e-12)
    assert neighbours.search(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert neighbours.search(frame, F.col("vec_id") < 0).count() == 0


def plain_prune(points, owner, candidates, degree, alpha):
    def far(a, b):
        return float(((points[a] - points[b]) ** 2).sum())

    left = sorted({c for c in candidates if c >= 0 and c != owner}, key=lambda c: (far(owner, c), c))
    kept = []
    while left and len(kept) < degree:
        kept.append(left[0])
        left = [c for c in left[1:] if alpha * alpha * far(kept[-1], c) > far(owner, c)]
    return kept


def test_robust_prune_equals_plain_loops():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(200, 5))
    candidates = rng.integers(-1, 200, (90, 40)).astype(np.int32)
    owners = rng.integers(0, 200, 90).astype(np.int32)
    for alpha in (1.0, 1.2, 2.0):
        got = neighbours.robust_prune(points, owners, candidates, 7, alpha)
        for own, some, kept in zip(owners, candidates, got):
            assert [c for c in kept if c >= 0] == plain_prune(points, own, some, 7, alpha)


@pytest.mark.parametrize("kind", ["clusters", "even", "line", "norms"])
def test_graph_reaches_all_nodes_and_finds_the_nearest(kind):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(2000, 16))
    if kind == "clusters":
        points = rng.normal(size=(8, 16))[rng.integers(0, 8, 2000)] * 5 + 0.1 * points
    elif kind == "line":
        points = np.arange(1, 2001)[:, None] * np.ones((1, 16))
    elif kind == "norms":
        points *= rng.exponential(size=(2000, 1))
    queries = np.concatenate([points[:100], rng.normal(size=(50, 16))])
    asked = np.concatenate([queries, np.zeros((150, 1))], axis=1).astype(np.float32)
    found = []
    bands = neighbours.bands(points)
    assert sorted(np.concatenate(bands).tolist()) == list(range(2000))
    for some in bands:
        lifted = neighbours.lifted(points[some])
        assert np.allclose((lifted ** 2).sum(axis=1), 1, atol=1e-5)
        edges, entry = neighbours.build(lifted)
        assert (edges < len(some)).all() and len(neighbours._entries(edges, entry)) == len(entry)
        beam, _ = neighbours.beam_search(lifted, (lifted ** 2).sum(axis=1), edges, entry, asked, 64)
        found.append(np.where(beam >= 0, some[beam], -1))
    scores = queries @ points.T
    least = -np.sort(-scores, axis=1)[:, 9]
    hits = [sum(scores[q, i] >= least[q] - 1e-4 * abs(least[q]) for i in set(row.tolist()) - {-1}) for q, row in enumerate(np.concatenate(found, axis=1))]
    assert np.minimum(hits, 10).mean() >= 9.0
