"""Golden rows taken from the reference's own unit tests and script smoke."""

import math

import pytest
from pyspark.sql import functions as F

from tillwise.operators import governance as gov
from tillwise.operators import imputation as imp
from tillwise.operators import pricing as pr


def test_fill_group_mean_floor_golden(spark):
    sales = [35, None, 67, 4, None, None, 32, 86, 72, 5]
    cat = [3, 0, 2, 0, 2, 5, 4, 0, 5, 5]
    rows = [(i, c, float(s) if s is not None else None) for i, (s, c) in enumerate(zip(sales, cat))]
    df = spark.createDataFrame(rows, "product_id int, category int, sales double")
    out = {r.product_id: r.sales for r in imp.fill_group_mean_floor(df, "sales", "category").collect()}
    assert out[1] == 45.0 and out[4] == 67.0 and out[5] == 38.0
    assert out[0] == 35.0 and out[9] == 5.0


def test_fill_keeps_input_and_documented_vs_floor_all(spark):
    df = spark.createDataFrame([(1, 1.5), (1, None), (2, None)], "g int, y double")
    before = sorted(df.collect(), key=str)
    doc = {(r.g, r.y) for r in imp.fill_group_mean_floor(df, "y", "g").collect()}
    assert (1, 1.5) in doc and (1, 1.0) in doc and (2, None) in doc
    allf = {(r.g, r.y) for r in imp.fill_group_mean_floor(df, "y", "g", floor_all=True).collect()}
    assert (1, 1.0) in allf
    assert sorted(df.collect(), key=str) == before


def test_fill_missing_columns_raise(spark):
    df = spark.createDataFrame([(1, 1.0)], "g int, y double")
    with pytest.raises(KeyError):
        imp.fill_group_mean_floor(df, "nope", "g")
    with pytest.raises(KeyError):
        imp.fill_group_mean_floor(df, "y", "nope")


def test_feasible_plan_and_lost_sales_golden(spark):
    df = spark.createDataFrame([("2024-01-01", 1, "A", 100.0, 3, 400.0)],
                               "date string, sku int, category string, price double, stock int, forecast_gmv double")
    r = gov.lost_sales(gov.feasible_plan(df)).first()
    assert r.forecast_units == 4 and r.feasible_units == 3 and r.feasible_gmv == 300.0
    assert r.is_stock_constrained is True
    assert r.lost_sales_units == 1 and r.lost_sales_gmv == 100.0


def test_quality_metrics_golden(spark):
    df = spark.createDataFrame([(10, 12, False), (10, 8, True)],
                               "actual_units int, forecast_units int, is_stock_constrained boolean")
    r = gov.quality_metrics(df).first()
    assert math.isclose(r.wape_non_oos, 0.2)


def test_supply_alert_fires(spark):
    df = spark.createDataFrame([(600.0, False, 10.0, 1, 1), (600.0, True, 10.0, 1, 1)],
                               "lost_sales_gmv double, is_stock_constrained boolean, price double, "
                               "actual_units int, forecast_units int")
    th = {"supply": {"lost_sales_gmv_week_min": 1000}, "model": {"wape_delta": 0.05}, "data": {"max_price": 1e9}}
    types = [r.type for r in gov.alerts(df, th).collect()]
    assert "SUPPLY" in types


def test_price_mask_script_golden(spark):
    rows = [(1, 40.0, 40.0, 100), (1, 40.0, 45.0, 80), (1, 40.0, 50.0, 55),
            (2, 100.0, 200.0, 300), (2, 100.0, 220.0, 280), (2, 100.0, 240.0, 200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id int, sku int, cost double, price double, qty int")
    for target in (0.2, 0.45):
        m = pr.price_mask(df, target, [F.col("row_id")])
        mask = [r.is_selected for r in m.orderBy("row_id").collect()]
        assert mask == [True, False, False, False, True, False]


def test_weighted_margin_of_gmv_plan(spark):
    rows = [(1, 40.0, 40.0, 100), (1, 40.0, 45.0, 80), (1, 40.0, 50.0, 55),
            (2, 100.0, 200.0, 300), (2, 100.0, 220.0, 280), (2, 100.0, 240.0, 200)]
    df = pr.candidate_metrics(spark.createDataFrame(rows, "sku int, cost double, price double, qty int"))
    g, w = pr.totals(pr.plan_max_gmv(df))
    assert math.isclose(w / g, 33600 / 65600)
