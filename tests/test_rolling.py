"""Rolling quantiles (E4) against plain Python: nulls, NaN, infinities, null keys, windows over several batches."""

import math
import random

import pytest

from tillwise.operators import timeseries as ts

FEATURES = {"x_3": ("x", 3, "quantile", 50), "x_7": ("x", 7, "quantile", 10), "x_7b": ("x", 7, "quantile", 90),
            "n_1": ("n", 1, "quantile", 25), "n_mean": ("n", 4, "avg", None)}


def quantile(window, n, q, full):
    v = sorted((x for x in window[-n:] if x is not None), key=lambda x: (math.isnan(x), x))
    if len(v) != n if full else not v:
        return None
    pos = (len(v) - 1) * q
    lo, hi = math.floor(pos), math.ceil(pos)
    return v[lo] if lo == hi else v[lo] + (pos - lo) * (v[hi] - v[lo])


def same(a, b):
    return a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b)))


@pytest.mark.parametrize("min_periods", ["one", "window"])
@pytest.mark.parametrize("batch", [2, 10000])
def test_rolling_quantiles_match_plain_python(spark, min_periods, batch):
    draw = random.Random(7)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0]
    rows = [(k, d, draw.choice(odd) if draw.random() < .3 else draw.uniform(-5, 5), draw.randrange(9), f"t{d}")
            for k, size in ((None, 9), ("a", 40), ("b", 1), ("c", 25), ("d", 6)) for d in range(size)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "sku string, day int, x double, n int, x_3 string")
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = ts.add_rolling_features(df, FEATURES, key="sku", min_periods=min_periods)
        assert got.columns == ["sku", "day", "x", "n", *FEATURES]
        got = {(r.sku, r.day): r for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for i, r in enumerate(mine):
            for name, (col, n, agg, q) in FEATURES.items():
                if agg == "quantile":
                    window = [float(m[3]) if col == "n" else m[2] for m in mine[:i + 1]]
                    assert same(got[(key, r[1])][name], quantile(window, n, q / 100, min_periods == "window")), (key, i, name)


def test_rolling_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([], "sku_id long, day date, qty long")
    assert ts.add_rolling_features(df).collect() == []
