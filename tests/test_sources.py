"""A-block round trips in private temporary folders, B6 / B13 checks."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tillwise.operators import inventory as inv
from tillwise.schemas import require_columns
from tillwise.sources import files


def _tmp():
    return tempfile.mkdtemp(prefix="tillwise-test-", dir="/tmp")


def test_csv_round_trip_and_parse_time(spark):
    d = _tmp()
    df = spark.createDataFrame([("1", "03/02/2024 10:00:00", "12.5"), ("2", "bad", "x")], "id string, ts string, v string")
    paths = files.write_tables({"t": df}, d, fmt="csv")
    back = files.read_csv(spark, paths["t"])
    assert sorted(back.columns) == ["id", "ts", "v"]
    parsed = files.with_parsed_time(back, "ts", day_first=True).orderBy("id").collect()
    assert parsed[0].ts.month == 2 and parsed[0].ts.day == 3 and parsed[1].ts is None


def test_delivery_json_loader(spark):
    d = _tmp()
    doc = {"forecast_demand": [{"product": "a", "marketplace": "WB", "forecast_percentiles": {"10": 3.0, "90": 9.0}},
                               {"product": "a", "marketplace": "WB", "forecast_percentiles": {"10": 4.0}}],
           "warehouse_stocks": [{"product": "a", "quantity": 10}, {"product": "b", "quantity": 5}],
           "bundle_sizes": [{"product": "a", "type": "small", "quantity": 2}],
           "transport_costs": [{"c": {"WB": {"small": 1.5}}}]}
    p = os.path.join(d, "delivery.json")
    with open(p, "w") as f:
        json.dump(doc, f)
    t = files.load_delivery_json(spark, p)
    fc = t["forecast"].collect()
    assert len(fc) == 1 and fc[0].demand == 4.0  # later duplicate wins
    assert [r.product for r in t["products"].collect()] == ["a", "b", "c"]
    bad = os.path.join(d, "bad.json")
    with open(bad, "w") as f:
        json.dump({k: v for k, v in doc.items() if k != "bundle_sizes"}, f)
    with pytest.raises(KeyError):
        files.load_delivery_json(spark, bad)


def test_restock_json_loader_and_validation(spark):
    d = _tmp()
    pct = {str(p): p for p in inv.REQUIRED_PERCENTILES}
    prods = [{"sku_id": 1, "price": 10.0, "cost": 8.0, "current_stock": 2, "storage_time": 3,
              "percentiles": {f"{w}w": pct for w in inv.REQUIRED_WEEKS}},
             {"sku_id": 2, "price": 5.0, "cost": 8.0, "current_stock": 0, "storage_time": 3,
              "percentiles": {"1w": pct}}]
    p = os.path.join(d, "restock.json")
    with open(p, "w") as f:
        json.dump(prods, f)
    flat = files.load_restock_json(spark, p)
    assert flat.count() == 4 * 7 + 7
    v = {r.rule: r.n_violations for r in inv.validate_restock(flat).collect()}
    assert v["price_lt_cost"] == 1 and v["missing_weeks"] == 1 and v["missing_percentiles"] == 1


def test_model_store_predictions_and_thresholds(spark):
    d = _tmp()
    coefs = spark.createDataFrame([(1, 7, 50, 0.5, [1.0, 2.0])], "sku_id long, horizon int, quantile_pct int, "
                                  "intercept double, coef array<double>")
    files.save_model_table(coefs, os.path.join(d, "model"))
    assert files.load_model_table(spark, os.path.join(d, "model")).count() == 1
    with pytest.raises(ValueError):
        files.upload_predictions(coefs, os.path.join(d, "pred"))
    files.upload_predictions(coefs.withColumn("pred_7d_q50", F.lit(1.0)), os.path.join(d, "pred"))
    tp = os.path.join(d, "th.json")
    with open(tp, "w") as f:
        json.dump({"supply": {"lost_sales_gmv_week_min": 5}}, f)
    assert files.read_thresholds(tp)["supply"]["lost_sales_gmv_week_min"] == 5
    alerts, meta = files.alert_report(coefs.select(F.lit("WARN").alias("level")), {"target": 0.2})
    assert meta.first().target == "0.2"


def test_require_columns_and_argument_checks(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        require_columns(df, ["a", "b"])
    for args in [(0, 1, "profit"), (10, 5, "profit"), (10, 1, "gmv")]:
        with pytest.raises(ValueError):
            inv.check_restock_args(*args)
    inv.check_restock_args(10, 2, "revenue")
