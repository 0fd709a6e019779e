"""Plans stay within what a driver and a task can hold: checked on the plans of small inputs."""

from __future__ import annotations

import re
import time
import tracemalloc
from datetime import date

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from tillwise.functions.components import components
from tillwise.operators import learning as ml
from tillwise.operators import modeling as md
from tillwise.operators import pricing as pr
from tillwise.operators import timeseries as ts
from tillwise.plans import demand
from tillwise.sources.fixtures import fx_price_candidates


def _plan(df, capsys, mode="simple") -> str:
    capsys.readouterr()
    df.explain(mode=mode)
    return capsys.readouterr().out


def _candidates(spark):
    rows = [(s, f"c{s % 3}", 8.0 + s % 5, 10.0 + k + s % 7, 20 + k * (s % 5 - 2), "regular") for s in range(60) for k in range(4)]
    return spark.createDataFrame(rows, "sku long, category string, cost double, price double, qty long, scenario_id string")


def test_repair_joins_go_by_sku(spark, capsys):
    cm = pr.candidate_metrics(_candidates(spark))
    plan = _plan(pr.repair_candidates(cm, pr.plan_max_gmv(cm)), capsys)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_price_mask_joins_go_by_sku(spark, capsys):
    for target in (0.0, 0.9):
        out = pr.price_mask(_candidates(spark), target, [-F.col("price"), F.col("cost")])
        assert "Broadcast" not in _plan(out, capsys)
        assert out.where("is_selected").select("sku").distinct().count() == 60


def test_candidates_are_dealt_by_part(spark, tmp_path, capsys):
    (spark.range(500).selectExpr("id as p_partkey", "'t' as p_type", "900 + id / 10 as p_retailprice")
     .coalesce(1).write.parquet(str(tmp_path / "part.parquet")))
    c = fx_price_candidates(spark, str(tmp_path))
    assert c.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert c.count() == 2500
    # the plan of each SKU is made where its candidates are
    assert _plan(pr.plan_max_gmv(pr.candidate_metrics(c)), capsys).count("Exchange") == 1


def test_size_estimates_stay_bounded_over_the_rounds_of_components(spark, capsys):
    n = 400
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels = components(chain)
    assert labels.select("label").distinct().count() == 1 and labels.count() == n
    digits = [int(x) for x in re.findall(r"E\+(\d+) B", _plan(labels, capsys, "cost"))]
    assert max(digits, default=0) < 200


def test_fits_of_a_set_of_rows_are_those_of_its_rows_alone():
    rng = np.random.default_rng(3)
    X = np.column_stack([rng.normal(size=300), rng.integers(0, 9, 300)])
    Y = np.column_stack([X @ [2.0, -1.0] + rng.normal(size=300), X @ [0.5, 3.0] + rng.normal(size=300)])
    sets = np.array([np.ones(300, dtype=bool), np.arange(300) < 240])
    got = md.fit_linear_quantiles(X, Y, [0.1, 0.9], sets)
    in_blocks = md.fit_linear_quantiles(X, Y, [0.1, 0.9], sets, block=64)
    np.testing.assert_allclose(in_blocks, got, atol=1e-7)
    for s, rows in enumerate(sets):
        for c, q in enumerate((0.1, 0.9)):
            np.testing.assert_allclose(got[s, c], _one_fit(X[rows], Y[rows, c], q), atol=1e-6)


def _one_fit(X, y, q):
    """Reweighted least squares of one regression, a step at a time."""
    A = np.hstack([np.ones((len(X), 1)), X])
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    for _ in range(60):
        r = y - A @ beta
        w = np.where(r >= 0, q, 1 - q) / np.maximum(np.abs(r), 1e-6)
        beta = np.linalg.solve((A * w[:, None]).T @ A + 1e-9 * np.eye(A.shape[1]), (A * w[:, None]).T @ y)
    return beta


def test_products_with_columns_constant_in_every_set_are_not_made():
    rng = np.random.default_rng(5)
    X = np.column_stack([np.tile(np.arange(60.0), (2000, 1)), rng.normal(size=(2000, 2))])
    Y = (X[:, 60:] @ [2.0, -1.0] + rng.normal(size=2000))[:, None]
    sets = np.array([np.ones(2000, dtype=bool), np.arange(2000) < 1500])
    tracemalloc.start()
    got = md.fit_linear_quantiles(X, Y, [0.3], sets)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 12e6  # all products: 63 * 64 / 2 columns of 2000 doubles, 32 MB
    assert (got[:, 0, 1:61] == 0).all()
    for s, rows in enumerate(sets):
        A, y = np.column_stack([np.ones(rows.sum()), X[rows][:, 60:]]), Y[rows, 0]
        errors = [y - A @ fit for fit in (got[s, 0][[0, 61, 62]], _one_fit(X[rows][:, 60:], y, 0.3))]
        losses = [np.maximum(0.3 * e, -0.7 * e).mean() for e in errors]
        np.testing.assert_allclose(losses[0], losses[1], rtol=1e-4)


def _orders(spark):
    rows = [("2024-01-04", 1, "a", 5.0, 2), ("2024-01-04", 1, "a", 6.0, 4), ("2024-02-10", 1, "b", 5.0, 7), ("2024-03-01", 4, "q", 9.0, 3),
            ("2024-01-01", 2, "c", 1.0, 1), (None, 3, "d", 2.0, 9), ("2024-03-06", None, "e", 3.0, 4), ("2024-02-06", 5, "z", 1.0, None)]
    return spark.createDataFrame(rows, "ts string, sku_id long, sku string, price double, qty long")


def test_the_days_of_the_split_are_not_looked_for_in_the_features(spark, monkeypatch):
    asked, bounds = [], ts.day_bounds
    monkeypatch.setattr(ts, "day_bounds", lambda df, day="day": asked.append(df.columns) or bounds(df, day))
    models = tuple(spark.createDataFrame([], md.COEF_SCHEMA) for _ in range(2))
    got = demand.demand_training(_orders(spark), 20, models)["features"]
    assert asked == [["day"]]  # once, and of the orders
    want = ts.train_test_split(got.drop("role"), 20)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.where("role = 'test'").count()


def test_days_before_those_read_are_not_made(spark):
    orders = _orders(spark)
    for since in (date(2023, 12, 1), date(2024, 1, 4), date(2024, 2, 8), date(2024, 3, 6)):
        got, want = ts.extract_sales(orders, since=since), ts.extract_sales(orders).where(F.col("day") >= F.lit(since))
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()


def test_the_days_of_a_key_are_made_where_its_sales_are(spark, capsys):
    rows = [("2024-01-04", 1, "a", 5.0, 2), ("2024-01-04", 1, "a", 6.0, 4), ("2024-01-10", 1, "b", 5.0, 7),
            ("2024-01-01", 2, "c", 1.0, 1), (None, 3, "d", 2.0, 9), ("2024-01-06", None, "e", 3.0, 4), ("2024-01-06", 5, "z", 1.0, None)]
    orders = spark.createDataFrame(rows, "ts string, sku_id long, sku string, price double, qty long")
    got = ts.extract_sales(orders)
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    sold = {(d, k): [r for r in rows if r[:2] == (d, k) and k is not None] for d in days for k in (1, 2, 3, None, 5)}
    dims = {k: {r[2:4] for r in rows if r[1] == k and k is not None} or {(None, None)} for k in (1, 2, 3, None, 5)}
    want = [(d, k, r[2] or a, r[3] or b, r[4] or 0) for (d, k), rs in sold.items()
            for r in (rs or [(None,) * 5]) for a, b in dims[k]]
    assert sorted(map(str, want)) == sorted(str((str(r.day), r.sku_id, r.sku, r.price, r.qty)) for r in got.collect())
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_boosting_rows_fill_their_partitions(spark, monkeypatch):
    rows = [(f"p{p}", w, float(p + w), float(p * w % 7)) for p in range(4) for w in range(24)]
    df = spark.createDataFrame(rows, "product string, week int, x double, y double").repartition(8)
    parts, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: parts.append(data.rdd.getNumPartitions()) or fit(self, data))
    report = md.cv_report(df, ["x"], "y", "week", n_splits=3, max_iter=2)
    assert report.count() == 3 and parts == [1, 1, 1]


def test_a_price_constant_within_its_key_leaves_the_fit_to_the_data():
    rng = np.random.default_rng(0)
    X = np.column_stack([np.full(2000, 20.0), rng.poisson(3, 2000) * rng.integers(0, 20, 2000), rng.normal(size=2000)])
    Y = (X[:, 1:2] * 3 + rng.exponential(5, (2000, 1))) @ np.ones((1, 3))
    at = rng.permutation(2000)
    a, b = (md.fit_linear_quantiles(x, y, [0.1, 0.5, 0.9])[0] for x, y in ((X, Y), (X[at], Y[at])))
    assert (a[:, 1] == 0).all() and (b[:, 1] == 0).all()
    r = [Y - np.column_stack([np.ones(2000), X]) @ fit.T for fit in (a, b)]
    q = np.array([0.1, 0.5, 0.9])
    losses = [np.maximum(q * x, (q - 1) * x).mean(axis=0) for x in r]
    np.testing.assert_allclose(losses[0], losses[1], rtol=1e-4)
    np.testing.assert_allclose((r[0] < 0).mean(axis=0), q, atol=0.01)


def _paths_node_by_node(X, forest):
    """All trees of a row step together: each step looks up node, feature and value of every tree."""
    roots = np.cumsum([0] + [len(t) for t in forest[:-1]])
    nodes = np.array([n for t in forest for n in t])
    shift = np.repeat(roots, [len(t) for t in forest])
    feat, thr, left, right = nodes[:, 0].astype(int), nodes[:, 1], (nodes[:, 2] + shift).astype(int), (nodes[:, 3] + shift).astype(int)
    rest = np.array([md._c_factor(int(n)) for n in nodes[:, 4]])
    out = []
    for lo in range(0, len(X), 1024):
        part = X[lo:lo + 1024]
        at, own = np.tile(roots, len(part)), np.repeat(np.arange(len(part)), len(roots))
        steps, active = np.zeros(len(at)), np.flatnonzero(feat[at] >= 0)
        while active.size:
            n = at[active]
            at[active] = n = np.where(part[own[active], feat[n]] < thr[n], left[n], right[n])
            steps[active] += 1
            active = active[feat[n] >= 0]
        out.append((steps + rest[at]).reshape(len(part), -1).mean(axis=1))
    return np.concatenate(out)


def test_rows_step_down_one_tree_at_a_time():
    rng = np.random.default_rng(0)
    X = np.column_stack([rng.integers(1, 51, 20000).astype(float), rng.normal(size=20000), rng.integers(0, 11, 20000) / 100])
    forest = [md._build_tree(X[rng.choice(20000, 256)], rng, 8) for _ in range(100)]
    forest[3] = [(-1, 0.0, -1, -1, 7)]
    X[0], X[1, 1], X[2, 0], X[3, 1] = np.nan, np.nan, np.inf, -np.inf
    for i, t in enumerate(forest[4:]):
        X[10 + i, t[0][0]] = t[0][1]  # a row at the threshold goes right
    flat = md._flat_forest(forest)
    took, got = [], []
    for f in (lambda: md._mean_path(X, flat), lambda: _paths_node_by_node(X, forest)):
        began = time.process_time()
        got.append(f())
        took.append(time.process_time() - began)
    np.testing.assert_allclose(got[0], got[1], rtol=1e-12)
    assert took[0] < took[1] / 2
    assert md._mean_path(X[:0], md._flat_forest([])).size == 0


def test_the_rows_of_a_tree_are_dealt_out(spark, monkeypatch):
    df = spark.range(600).selectExpr("id", "double(id % 20) as a", "double(id % 7) as b", "if(id % 20 > 9, 5, 0) as y").coalesce(1)
    parts, fit = [], DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, data: parts.append(data.rdd.getNumPartitions()) or fit(self, data))
    for sizes in ({"rows_per_task": 100}, {}):
        out = ml.tree_scoring(df, ["a", "b"], "y", **sizes).collect()
        assert [r["id"] for r in out] == list(range(600)) and all(abs(r["prediction"] - r["y"]) < 1e-9 for r in out)
    assert parts == [6, 1]  # few rows stay as they are
