import pytest
from pyspark.sql import functions as F

from tellstar.operators import aggregates as agg
from tellstar.operators import landing as ld
from tellstar.plans import marts as mt
from tellstar.plans import reports as rp

AF_SCHEMA = ("scored_answer_sk string, retriever string, display_label string, sort_order int, type_id string, "
             "type_display_label string, generator_model_family string, writer_model string, "
             "writer_model_family string, harness_version string, passed int, total_tokens bigint, "
             "total_cost_usd double, retrieval_latency_ms double, generation_latency_ms double")


def _af(spark, rows):
    return spark.createDataFrame(rows, AF_SCHEMA)


H = "claude-haiku-4-5"


def row(i, ret, label, order, t="01_x", passed=1, cost=0.01, rl=10.0, gl=20.0, fam=H, writer=None, hv="v1"):
    return (f"k{i}", ret, label, order, t, t, fam, writer, writer and writer[:16], hv, passed, 100, cost, rl, gl)


def test_accuracy_cells_drop_null_keys(spark):
    df = _af(spark, [row(1, "vector", "V", 2), row(2, "vector", "V", 2, passed=0), row(3, "hybrid", None, None)])
    cells = agg.pass_rates(df, ["display_label", "type_id"]).collect()
    assert len(cells) == 1
    c = cells[0]
    assert (c.total, c.passed, c.accuracy, c.avg_tokens) == (2, 1, 0.5, 100.0)


def test_best_retriever_ties_go_to_first_label_and_legacy_is_excluded(spark):
    df = _af(spark, [row(1, "vector", "B label", 2), row(2, "closed_book", "A label", 1),
                     row(3, "graph_neighborhood", "0 legacy", 3)])
    b = rp.best_retriever(df).first()
    assert (b.best_label, b.best_accuracy) == ("A label", 1.0)
    empty = rp.best_retriever(df.where("false")).first()
    assert empty.best_label == "—" and empty.best_accuracy is None


def test_headline_guards(spark):
    df = _af(spark, [row(1, "vector", "V", 2, passed=0, cost=None), row(2, "vector", "V", 2, passed=0, cost=0.5)])
    h = rp.report_headline(df).first()
    assert h.scored == 2 and h.num_correct == 0 and h.pass_rate == 0.0
    assert h.total_cost == 0.5 and h.cost_per_correct is None
    e = rp.headline_kpis(df.where("false")).first()
    assert e.scored == 0 and e.pass_rate == 0.0 and e.total_cost == 0.0


def test_cost_per_correct_and_latency_means_skip_nulls(spark):
    df = _af(spark, [row(1, "closed_book", "C", 1, rl=None, gl=10.0), row(2, "closed_book", "C", 1, rl=None, gl=30.0,
                                                                           passed=0)])
    r = rp.report_cost_per_correct(df).first()
    assert r.avg_retrieval_ms is None and r.avg_latency_ms == 20.0
    assert r.cost_per_correct == pytest.approx(0.02)
    long = rp.report_latency_split(df).collect()
    phases = {x.phase: (x.avg_latency_ms, x.phase_order) for x in long}
    assert phases == {"Retrieval": (None, 0), "Generation": (20.0, 1)}  # melt keeps NULL rows


def test_harness_slice_writer_rule(spark):
    df = _af(spark, [row(1, "graph_sparqlgen", "S", 6, writer="claude-haiku-4-5-2025"),
                     row(2, "graph_sparqlgen", "S", 6, writer="claude-sonnet-4-5-2025"),
                     row(3, "vector", "V", 2), row(4, "vector", "V", 2, fam="other")])
    assert sorted(r.scored_answer_sk for r in rp.harness_slice(df).collect()) == ["k1", "k3"]
    assert rp.harness_versions(df).first().version_count == 1


def test_first_row_per_group_is_a_whole_row(spark):
    df = spark.createDataFrame([("t1", "q2", "b", "gt2"), ("t1", "q1", "a", None), ("t2", "q9", "z", "gt9")],
                               "type_id string, question_id string, question_text string, gt string")
    got = {r.type_id: (r.question_id, r.question_text, r.gt)
           for r in agg.first_row_per_group(df, "type_id", "question_id", ["question_text", "gt"]).collect()}
    assert got == {"t1": ("q1", "a", None), "t2": ("q9", "z", "gt9")}


def test_distinct_sorted_list(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "w string")
    assert agg.distinct_sorted_list(df, "w").first().w_list == "a, b"
    assert agg.distinct_sorted_list(df.where("false"), "w").first().w_list == "—"


def test_reports_end_to_end_on_fixture(spark, tree, tmp_path):
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    ld.land_all(spark, tree, raw)
    mt.build_star(spark, raw, marts)
    af = rp.analysis_frame(spark, marts)
    assert af.count() == 7
    cpc = {r.display_label: r for r in rp.report_cost_per_correct(af).collect()}
    assert set(cpc) == {"Dense vector (Chroma)", "Text to SPARQL", "Closed book (no retrieval)"}
    assert cpc["Text to SPARQL"].correct == 1 and cpc["Text to SPARQL"].total == 2
    gt = {r.type_id: r for r in rp.report_ground_truth(mt.load_mart(spark, marts, "dim_question")).collect()}
    assert gt["04_3plus_hop_traversal"].ground_truth_answer_text == "— (unanswerable)"
    assert gt["02_1hop_factoid"].n_questions == 1
    unseeded = af.where(F.col("scored_answer_sk").isNotNull() & F.col("type_id").isNull()).count()
    assert unseeded == 1


def test_materialized_analysis_frame_equals_computed(spark, tree, tmp_path):
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    ld.land_all(spark, tree, raw)
    mt.build_star(spark, raw, marts)
    computed = rp.analysis_frame(spark, marts)
    assert rp.load_analysis(spark, marts).count() == computed.count()  # falls back before materialising
    rp.materialize_analysis(spark, marts)
    served = rp.load_analysis(spark, marts)
    assert served.exceptAll(computed).count() == 0 and computed.exceptAll(served).count() == 0
    assert "Join" not in served._jdf.queryExecution().optimizedPlan().toString()


def test_dashboard_blocks(spark, tree, tmp_path):
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    ld.land_all(spark, tree, raw)
    mt.build_star(spark, raw, marts)
    rp.materialize_analysis(spark, marts)
    d = rp.dashboard(spark, marts)
    assert d["pricing_sources"].first()[0] == "override, portkey"
    assert d["harness_version_count"].first().version_count == 1
    assert d["headline"].count() == 1
    assert "Model" in d["pricing_reference"].columns
