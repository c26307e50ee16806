import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tellstar.llm import negatives
from tellstar.llm.queries import ORACLE, op12_hard_negatives

SF = "/root/testdata/sf0.001"


def held(x, most):
    return max(-most, min(most, x))


def brute(rows, is_anchor, positives=5, wanted=5, share=(80, 100)):
    """rows: (vec_id, label, vector); every pair by plain integers."""
    v = [(i, c, [int(held(math.floor(256 * x) if abs(x) < 1e300 else math.copysign(1e305, x), 2 ** 500)) for x in e]) for i, c, e in rows
         if i is not None and c is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    asked = {i: (c, e) for i, c, e in sorted(v, key=lambda r: (r[2], r[1]), reverse=True) if is_anchor(i)}
    out = []
    for a, (label, e) in asked.items():
        scored = sorted((-held(sum(x * y for x, y in zip(e, f)), 2 ** 63 - 1), i, c) for i, c, f in v if i != a and len(f) == len(e))
        for p, (ps, pid, _) in enumerate([s for s in scored if s[2] == label][:positives]):
            below = [(s, i) for s, i, c in scored if c != label and share[0] * -ps <= share[1] * -s <= share[1] * -ps][:wanted]
            out += [(a, pid, r + 1, i, -ps, -s, p + 1) for r, (s, i) in enumerate(below)]
    return sorted(out)


def test_query_equals_brute_force_and_sql(spark):
    got = sorted(tuple(r) for r in op12_hard_negatives(spark, SF).collect())
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got == brute(rows, lambda i: i % 100 == 0)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(duckdb.sql(ORACLE["op12_hard_negatives"]).fetchall()) == got


def test_clusters_ties_odd_rows_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 12))
    rows = [(i, i // 6 % 3, (centres[i % 6] + 0.4 * rng.normal(size=12)).tolist()) for i in range(600)]
    rows += [(1000 + i, i % 2, [0.25] * 12) for i in range(90)]  # ties across labels, a hot vector
    rows += [(2000, 1, None), (2010, None, [1.0] * 12), (2020, 1, [None] * 12), (2030, 0, [float("nan")] * 12), (None, 1, [1.0] * 12),
             (2040, 0, []), (2041, 1, []), (2042, 0, []), (2050, 0, [1.0, 2.0]), (2051, 0, [2.0, 1.0]), (2052, 1, [1.0, 1.9]), (10, 1, rows[10][2]), (10, 2, rows[11][2]),
             (2060, 0, [0.0] * 12), (2070, 2, [3e18] + [1e18] * 11), (2071, 2, [1e18] * 12), (2072, 0, [9e17] * 12), (2080, 1, [1e307] * 12), (2090, 5, [1.0] * 12)]
    frame = spark.createDataFrame([(i, c, v, i) for i, c, v in rows], "vec_id long, label int, embedding array<double>, score long").repartition(3)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500 and len({r[0] for r in want}) > 50
    for size, first, anchors in ((8 << 20, 256, 256), (2000, 16, 7)):
        monkeypatch.setattr(negatives, "BLOCK_BYTES", size)
        monkeypatch.setattr(negatives, "FIRST", first)
        monkeypatch.setattr(negatives, "ANCHORS", anchors)
        if size == 2000:
            monkeypatch.setattr(negatives, "BLOCK_BYTES", 20000)
        assert sorted(tuple(r) for r in negatives.mined(frame, F.col("vec_id") % 10 == 0).collect()) == want
    assert negatives.mined(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mined(frame, F.col("vec_id") < 0).count() == 0


def test_threshold_join_finds_all_pairs_and_leaves_rows_out():
    rng = np.random.default_rng(3)
    energy = 40 * 0.8 ** np.arange(30)
    rows, anchors = (np.floor(rng.normal(size=(n, 30)) * energy) for n in (500, 40))
    index = negatives.Index(rows)
    mine = anchors[:, index.order]
    for quantile in (0.0, 0.5, 0.99):
        scores = anchors @ rows.T
        need = np.quantile(scores, quantile, axis=1)
        got = [np.concatenate(x) for x in zip(*index.join(mine, negatives.rests(mine), need))]
        want = np.nonzero(scores >= need[:, None])
        order = np.lexsort((got[1], got[0]))
        assert np.array_equal(got[0][order], want[0]) and np.array_equal(got[1][order], want[1])
        assert np.array_equal(got[2][order], scores[want].astype(np.int64))
