import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tellstar.functions.jsonx import array_length_or_zero, ground_truth_text, is_json_array, jsub, jtext, jtyped, parsed
from tellstar.functions.keys import model_family, surrogate_key
from tellstar.functions.scalars import (
    guarded_ratio,
    hop_count,
    infer_mechanism,
    not_in_or_null,
    nullif_empty,
    passed_flag,
    split_part_or_empty,
    token_cost,
    usd_per_mtok,
)


def test_surrogate_key_matches_md5_with_sentinel(spark):
    df = spark.createDataFrame([("a", None, 0.0)], "x string, y string, t double")
    got = df.select(surrogate_key("x", "y", "t").alias("k")).first().k
    assert got == hashlib.md5("a|∅|0.0".encode()).hexdigest()


def test_surrogate_key_distinguishes_null_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    keys = {r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()}
    assert len(keys) == 2


def test_model_family(spark):
    df = spark.createDataFrame([("claude-haiku-4-5-20251001",), ("qwen2.5:3b-instruct",), (None,), ("x-2025",)], "m string")
    assert [r.f for r in df.select(model_family("m").alias("f")).collect()] == [
        "claude-haiku-4-5", "qwen2.5:3b-instruct", None, "x-2025"]


def test_hop_count_order_and_default(spark):
    df = spark.createDataFrame([("04_3plus_hop_traversal",), ("03_2hop_traversal",), ("02_1hop_factoid",),
                                ("01_0hop_attribute",), ("05_aggregative",)], "t string")
    assert [r.h for r in df.select(hop_count("t").alias("h")).collect()] == [3, 2, 1, 0, None]


def test_mechanism_explicit_else_inferred_with_like_wildcard(spark):
    df = spark.createDataFrame([(None, "vector"), (None, "graph_neighborhood_2hop"), (None, "graphXneighborhood"),
                                ("dense", "closed_book"), (None, "closed_book"), (None, "hybrid")], "m string, r string")
    got = [r.x for r in df.select(infer_mechanism("m", "r").alias("x")).collect()]
    # '_' in the LIKE pattern is a single-character wildcard
    assert got == ["dense", "neighborhood", "neighborhood", "dense", "none", None]


def test_json_text_and_typed(spark):
    df = spark.createDataFrame([('{"a": 0.0, "n": null, "o": {"b": 5}, "t": "2026-05-04T08:15:42+0200"}',)], "payload string")
    v = parsed("payload")
    r = df.select(jtext(v, "a").alias("a"), jtext(v, "n").alias("n"), jtext(v, "missing").alias("m"),
                  jtyped(v, "o.b", "bigint").alias("b"), jtyped(v, "t", "timestamp").alias("t"),
                  jsub(v, "o").isNotNull().alias("has_o")).first()
    assert r.n is None and r.m is None and r.b == 5 and r.has_o
    assert float(r.a) == 0.0
    assert r.t.isoformat() == "2026-05-04T06:15:42"


def test_ground_truth_text_cases(spark):
    rows = [('{"g": ["A", "B"]}',), ('{"g": "X"}',), ('{"g": []}',), ('{"g": ["", null, "C"]}',), ('{"g": [null]}',),
            ('{"g": [""]}',), ("{}",)]
    df = spark.createDataFrame(rows, "payload string")
    v = parsed("payload")
    got = [r.t for r in df.select(ground_truth_text(v, "g").alias("t")).collect()]
    assert got == ["A, B", "X", None, ", C", None, "", None]
    arr = [r.a for r in df.select(is_json_array(jsub(v, "g")).alias("a")).collect()]
    assert arr[:2] == [True, False]


def test_array_length_or_zero(spark):
    df = spark.createDataFrame([('{"s": ["a", "b"]}',), ('{"s": []}',), ("{}",)], "payload string")
    got = [r.n for r in df.select(array_length_or_zero(parsed("payload"), "s").alias("n")).collect()]
    assert got == [2, 0, 0]


def test_unit_conversion_exact_from_exponent_text(spark):
    df = spark.createDataFrame([("4e-05",), ("0.0000375",), ("8e-06",)], "p string")
    got = [r.r for r in df.select(usd_per_mtok(F.col("p")).alias("r")).collect()]
    assert got == [Decimal("0.400000"), Decimal("0.375000"), Decimal("0.080000")]


def test_token_cost_keeps_tiny_amounts_and_nulls_missing_rates(spark):
    df = spark.createDataFrame([(1, Decimal("0.1"), None, Decimal("1.0")), (None, Decimal("2"), 5, None)],
                               "t1 bigint, r1 decimal(14,6), t2 bigint, r2 decimal(14,6)")
    got = [r.c for r in df.select(token_cost(("t1", "r1"), ("t2", "r2")).alias("c")).collect()]
    assert got[0] == Decimal("1E-7")  # 1 token x 0.1 USD/Mtok is 1e-7 USD, not rounded away
    assert got[1] is None  # a missing rate nulls the cost; missing tokens count as 0


def test_small_helpers(spark):
    df = spark.createDataFrame([(True, "", "3-MEDIUM", 3, 0), (None, "x", None, 1, 2)],
                               "p boolean, e string, s string, n int, d int")
    r = df.select(passed_flag("p").alias("pf"), nullif_empty("e").alias("e"),
                  split_part_or_empty("s", "-", 2).alias("sp"), guarded_ratio("n", "d").alias("g"),
                  not_in_or_null("s", ["3-MEDIUM"]).alias("keep")).collect()
    assert [x.pf for x in r] == [1, 0]
    assert [x.e for x in r] == [None, "x"]
    assert [x.sp for x in r] == ["MEDIUM", ""]
    assert [x.g for x in r] == [None, 0.5]
    assert [x.keep for x in r] == [False, True]  # a NULL value is kept, unlike SQL NOT IN
