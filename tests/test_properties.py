"""Property tests against plain-Python brute force on small random inputs."""

import hashlib
import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellstar.functions.keys import model_family, surrogate_key
from tellstar.functions.scalars import token_cost
from tellstar.operators.ordinality import line_numbers

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
text = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12))


@SETTINGS
@given(rows=st.lists(st.tuples(text, text, st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=20))
def test_surrogate_key_equals_python_md5(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c int")
    got = [r.k for r in df.select(surrogate_key("a", "b", "c").alias("k")).collect()]

    def py(*vals):
        return hashlib.md5("|".join("∅" if v is None else str(v) for v in vals).encode("utf-8")).hexdigest()

    assert got == [py(*r) for r in rows]


@SETTINGS
@given(names=st.lists(st.from_regex(r"[a-z0-9.:-]{0,10}(-[0-9]{6,9})?", fullmatch=True), min_size=1, max_size=20))
def test_model_family_equals_python_regex(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = [r.f for r in df.select(model_family("m").alias("f")).collect()]
    assert got == [re.sub(r"-\d{8}$", "", n) for n in names]


rate = st.one_of(st.none(), st.decimals(min_value=0, max_value=1000, places=6, allow_nan=False, allow_infinity=False))
tokens = st.one_of(st.none(), st.integers(0, 10**9))


@SETTINGS
@given(rows=st.lists(st.tuples(tokens, rate, tokens, rate), min_size=1, max_size=15))
def test_token_cost_equals_exact_decimal_arithmetic(spark, rows):
    df = spark.createDataFrame(rows, "t1 bigint, r1 decimal(14,6), t2 bigint, r2 decimal(14,6)")
    got = [r.c for r in df.select(token_cost(("t1", "r1"), ("t2", "r2")).alias("c")).collect()]

    def py(t1, r1, t2, r2):
        if r1 is None or r2 is None:
            return None
        return ((t1 or 0) * r1 + (t2 or 0) * r2) * Decimal("0.000001")

    assert [None if g is None else Decimal(g) for g in got] == [py(*r) for r in rows]


@SETTINGS
@given(
    files=st.lists(st.lists(st.one_of(st.just(""), st.just("   "), st.integers(0, 10**6).map(str)), max_size=300),
                   min_size=1, max_size=4),
    split=st.sampled_from([256, 1024, 1 << 20]),
)
def test_line_numbers_equal_enumerate_over_non_blank_lines(spark, tmp_path_factory, files, split):
    d = tmp_path_factory.mktemp("lines")
    expected = {}
    for i, lines in enumerate(files):
        p = d / f"f{i}.jsonl"
        p.write_text("\n".join(lines) + "\n")
        kept = [ln.strip() for ln in lines if ln.strip()]
        expected[p.name] = list(enumerate(kept))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = spark.read.text(str(d)).select(
            F.trim("value").alias("v"), F.col("_metadata.file_name").alias("f"),
            F.col("_metadata.file_block_start").alias("b")).where(F.col("v") != "")
        got = {}
        for r in line_numbers(df, "f", "b").collect():
            got.setdefault(r.f, []).append((r.line_no, r.v))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}
