"""Plan-shape guarantees the pipeline relies on at scale (checked on the physical plans)."""

import re

import pytest

from tellstar.operators import aggregates as agg
from tellstar.operators import landing as ld
from tellstar.plans import marts as mt
from tellstar.plans import reports as rp
from tellstar.plans import staging as st
from tellstar.sources import landing_files as lf


def _plan(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture()
def built(spark, tree, tmp_path):
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    ld.land_all(spark, tree, raw)
    mt.build_star(spark, raw, marts)
    return raw, marts


def test_no_python_evaluation_anywhere(spark, built):
    raw, marts = built
    af = rp.analysis_frame(spark, marts)
    for df in (mt.Relations(spark, raw).enriched(), rp.report_headline(af), rp.report_latency_split(af),
               rp.report_ground_truth(mt.load_mart(spark, marts, "dim_question"))):
        p = _plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_report_reads_only_needed_fact_columns_and_pushes_dimension_filter(spark, built):
    _, marts = built
    plan = _plan(rp.report_accuracy_matrix(rp.analysis_frame(spark, marts)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    fact_schema = [s for s in schemas if "is_passed" in s]
    assert fact_schema and len(fact_schema[0].split(",")) <= 10  # of 35 fact columns
    assert "EqualTo(generator_model_family,claude-haiku-4-5)" in plan
    assert "BroadcastHashJoin" in plan


def test_hot_groups_use_aggregates_not_windows(spark, tree):
    d = lf.dedupe_run_batches(lf.scan_manifests(spark, tree))
    assert "Window" not in _plan(d) and "Aggregate" in _plan(d)
    q = spark.createDataFrame([("t", "q1", "x")], "type_id string, question_id string, question_text string")
    f = agg.first_row_per_group(q, "type_id", "question_id", ["question_text"])
    assert "Window" not in _plan(f)


def test_payload_parsed_once_per_row(spark, built):
    raw, _ = built
    df = st.explode_answers(mt.Relations(spark, raw).raw("scored_answer"))
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json") == 1 and optimized.count("parse_json") == 0


def test_seeds_are_broadcast(spark, built):
    raw, marts = built
    enriched = mt.read_table(spark, f"{marts}/_int/int_scored_answers_enriched")
    from tellstar.sources.seeds import seed

    p = _plan(mt.dim_retriever_cond(enriched, seed(spark, "seed_retriever_labels")))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def _rows_read(df) -> int:
    """Rows that the scan of a collected frame without shuffles handed on."""
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_serving_order_skips_rows(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 2).selectExpr(
        "id", f"CASE WHEN id % 5 = 0 THEN '{rp.HAIKU_FAMILY}' ELSE 'family-' || id % 5 END AS generator_model_family",
        f"CASE WHEN id % 7 = 0 THEN '{rp.SPARQL_RETRIEVER}' WHEN id % 7 > 1 THEN 'retriever-' || id % 7 END AS retriever")
    read, found = {}, {}
    for name, frame in (("plain", rows), ("clustered", rp.clustered(rows))):
        frame.write.parquet(f"{tmp_path}/{name}")
        for slice_ in (rp.fixed_generator, rp.sparql_only):
            hits = slice_(spark.read.parquet(f"{tmp_path}/{name}")).select("id")
            found[name, slice_] = sorted(r.id for r in hits.collect())
            read[name, slice_] = _rows_read(hits)
    for slice_, every in ((rp.fixed_generator, 5), (rp.sparql_only, 35)):
        assert found["clustered", slice_] == found["plain", slice_] == list(range(0, 400_000, every))
        assert read["plain", slice_] == 400_000
    assert read["clustered", rp.fixed_generator] <= 160_000 and read["clustered", rp.sparql_only] <= 90_000


def test_serving_table_is_written_without_a_shuffle_for_its_order(spark, built):
    _, marts = built
    frame = rp.analysis_frame(spark, marts)
    assert _plan(rp.clustered(frame)).count("Exchange") == _plan(frame).count("Exchange")


def test_captions_are_joined_by_range(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE 'n' || id % 4001 END AS name")
        got = agg.distinct_sorted_list(rows, "name", sep="|")
        assert "rangepartitioning" in _plan(got)
        text = got.first().name_list
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert text.split("|") == sorted({f"n{i % 4001}" for i in range(30_000) if i % 3})
