import math

import duckdb
import numpy as np

from pyspark.sql import functions as F

from tellstar.llm import topk
from tellstar.llm.queries import ORACLE, op5_topk

SF = "/root/testdata/sf0.001"


def brute(rows, is_query, k=5):
    v = [(i, [math.floor(256 * float(x)) if abs(x) < 1e300 else int(math.copysign(1.7976931348623157e308, x)) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, e in sorted({i: e for i, e in sorted(v, reverse=True) if is_query(i)}.items()):
        found = sorted((-min(max(sum(a * b for a, b in zip(e, f)), -2**63), 2**63 - 1), i) for i, f in v if i != q and len(f) == len(e))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def test_query_equals_brute_force_and_sql(spark):
    got = sorted(tuple(r) for r in op5_topk(spark, SF).collect())
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got == brute(rows, lambda i: i % 50 == 0)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(duckdb.sql(ORACLE["op5_topk"]).fetchall()) == got


def test_ties_odd_vectors_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(i, [0.5, -0.25, 0.125]) for i in range(100, 160)]
    rows += [(200, None), (50, [1.0, None, 2.0]), (250, [1.0, float("nan"), 0.0]), (300, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
             (350, [1.0, 2.0]), (400, []), (401, []), (351, [3.0, -1.0]), (0, rows[0][1]), (450, [3e18, 1e18, -2e18]), (500, [1e30, 0.0, 1.0]), (550, [1e307, -1e307, 0.0])]
    frame = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, score long").repartition(3)
    want = brute(rows, lambda i: i % 50 == 0)
    for size in (8 << 20, 40):
        monkeypatch.setattr(topk, "BLOCK_BYTES", size)
        got = sorted(tuple(r) for r in topk.search(frame, F.col("vec_id") % 50 == 0).collect())
        assert got == want
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.search(frame, F.col("vec_id") < 0).count() == 0
