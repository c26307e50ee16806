import datetime as dt

from tellstar.operators import quality as dq
from tellstar.operators.pricing_snapshot import CatalogShapeError, build_snapshots, catalog_shape

import pytest


def test_check_semantics(spark):
    child = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), ("b", "z")], "k string, v string")
    parent = spark.createDataFrame([("x",), ("z",)], "v string")
    tables = {"c": child, "p": parent}
    res = {(r.check, r.column): r.failures for r in dq.run_checks(tables, [
        dq.Check("not_null", "c", "k"),
        dq.Check("unique", "c", "k"),
        dq.Check("accepted_values", "c", "v", values=("x", "z")),
        dq.Check("relationships", "c", "v", parent="p", parent_column="v"),
    ]).collect()}
    assert res == {("not_null", "k"): 1, ("unique", "k"): 1, ("accepted_values", "v"): 1, ("relationships", "v"): 1}


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp")
    assert dq.freshness(df, "t", dt.datetime(2024, 1, 2)).first().status == "pass"
    assert dq.freshness(df, "t", dt.datetime(2024, 1, 4)).first().status == "warn"
    assert dq.freshness(df, "t", dt.datetime(2024, 1, 9)).first().status == "error"


def test_price_shape_and_snapshot(spark):
    good = '{"m1": {"pricing_config": {"pay_as_you_go": {"request_token": {"price": 1e-05}}}}, "m0": {}}'
    models = spark.createDataFrame([("p", good)], "provider string, models_json string")
    shape = catalog_shape(models).first()
    assert (shape.n_models, shape.n_with_request_price, shape.ok) == (2, 1, True)
    snap = build_snapshots(models, ref="main", fetched_at="2026-06-27").first().snapshot
    assert snap.startswith('{"meta":') and '"model_count":2' in snap and snap.index('"m0"') < snap.index('"m1"')
    bad = spark.createDataFrame([("q", "[]"), ("r", '{"m": {}}')], "provider string, models_json string")
    with pytest.raises(CatalogShapeError):
        build_snapshots(bad, ref="main", fetched_at="2026-06-27")
