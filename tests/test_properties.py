"""Properties of the operators whose results the driver checks by rows only."""

import numpy as np
from pyspark.sql import functions as F

from tillwise.operators import inventory as inv
from tillwise.operators import metrics as mt
from tillwise.operators import modeling as md
from tillwise.sources.fixtures import fx_delivery, fx_restock

from settings import SF_SMALL


def test_restock_greedy_and_lp_respect_budget(spark):
    scores = inv.restock_scores(fx_restock(spark, SF_SMALL), 2)
    for budget in (5_000, 200_000):
        g = inv.restock_greedy(scores, budget, "profit")
        spent = g.agg(F.sum("allocated_budget")).first()[0] or 0.0
        assert spent <= budget + 1e-6
        assert g.groupBy("sku_id").count().where("count > 1").count() == 0
        alloc, info = inv.restock_lagrangian(scores, budget, "profit")
        assert info["spent"] <= budget + 1e-6 and info["value"] <= info["dual_bound"] + 1e-6


def _greedy_loop(rows, budget):
    """One row after the other: as much as the demand and the rest of the budget allow."""
    out = {}
    for sku, cost, demand, _ in sorted(rows, key=lambda r: (-r[3], r[0])):
        qty = min(demand, int(budget // cost))
        if qty > 0:
            out[sku] = float(qty)
            budget -= qty * cost
    return out


def test_greedy_phases_equal_a_plain_loop(spark):
    scores = inv.restock_scores(fx_restock(spark, SF_SMALL), 3)
    for goal, budget in (("revenue", 50_000), ("profit", 3_000), ("profit", 10**9)):
        rows = [(r.sku_id, r.cost, r.demand_to_buy, r[f"{goal}_score"]) for r in inv.first_choice(scores, goal).collect()]
        got = {r.sku_id: r.allocated_qty for r in inv.restock_greedy(scores, budget, goal).collect()}
        assert got == _greedy_loop(rows, budget)


def test_greedy_phases_on_random_costs(spark):
    rng = np.random.default_rng(4)
    for budget in (37, 500, 6000):
        rows = [(i, float(rng.integers(1, 400)), int(rng.integers(1, 9)), float(rng.integers(0, 30))) for i in range(120)]
        df = spark.createDataFrame(rows, "sku_id long, cost double, demand_to_buy long, score double").repartition(4)
        got = {r.sku_id: r.allocated_qty for r in inv._buy_in_order(df, budget, "score").collect()}
        assert got == _greedy_loop(rows, budget)


def test_bundle_delivery_within_bounds(spark):
    src = fx_delivery(spark, SF_SMALL)
    out = inv.bundle_delivery(src)
    j = out.join(src, ["product", "marketplace"])
    ok = j.where(F.col("status") == "optimal")
    assert ok.where((F.col("units") < F.col("min_demand")) | (F.col("units") > F.col("max_demand"))).count() == 0
    tot = ok.groupBy("product").agg(F.sum("units").alias("u"), F.first("stock").alias("s"))
    assert tot.where(F.col("u") > F.col("s")).count() == 0


def test_quantile_fit_beats_constant():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([1.0, -2.0, 0.5]) + rng.standard_t(3, size=400)
    for q in (0.1, 0.5, 0.9):
        b = md.fit_linear_quantile(X, y, q)
        pred = b[0] + X @ b[1:]

        def loss(p):
            d = y - p
            return np.mean(q * np.maximum(d, 0) + (1 - q) * np.maximum(-d, 0))
        assert loss(pred) < loss(np.quantile(y, q))
        assert abs(np.mean(y <= pred) - q) < 0.05


def test_gbt_small_and_isolation_forest(spark):
    rows = [(float(i % 7), float(i % 5), float((i % 7) * 2 + (i % 5))) for i in range(300)]
    df = md.assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"])
    model = md.gbt_regressor(max_iter=5, step=0.5).fit(df)
    err = mt.forecast_errors(model.transform(df), "y", "prediction").first()
    assert err.wape < 0.5
    pts = [(str(i), float(i % 10), float(i % 10)) for i in range(300)] + [("out", 100.0, -100.0)]
    d = spark.createDataFrame(pts, "rid string, a double, b double")
    forest, psi = md.isolation_forest(d, ["a", "b"], n_trees=20, max_samples=64, id_col="rid")
    sc = {r.rid: r.score for r in md.isolation_scores(d, ["a", "b"], forest, psi).collect()}
    assert sc["out"] == max(sc.values())
    # every row's path, tree by tree and node by node
    for rid, a, b in pts[:5] + pts[-1:]:
        paths = []
        for tree in forest:
            at, depth = 0, 0
            while tree[at][0] >= 0:
                f, t, left, right, _ = tree[at]
                at, depth = left if (a, b)[f] < t else right, depth + 1
            paths.append(depth + md._c_factor(tree[at][4]))
        assert abs(sc[rid] - 2 ** (-np.mean(paths) / md._c_factor(psi))) < 1e-12


def test_adstock_equals_a_plain_loop(spark):
    from tillwise.operators import learning as ml
    rows = [(k, d, float((7 * d + len(k or '')) % 5) if d % 6 else None, d) for k in ("a", "bb", None) for d in range(90)]
    df = spark.createDataFrame(rows, "k string, day int, x double, n int").repartition(5)
    want, s = {}, {}
    for k, d, x, n in rows:
        s[k] = (x or 0.0) + 0.8 * s.get(k, 0.0)
        want[k, d] = s[k]
    got = {(r.k, r.day): r.x_adstock for r in ml.adstock(df, ["k"], "day", ["x", "n"], 0.8).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    one = ml.adstock(df.where("k = 'a'"), [], "day", ["x"], 0.8)
    assert all(abs(r.x_adstock - want["a", r.day]) < 1e-9 for r in one.collect())
    assert ml.adstock(df.limit(0), [], "day", ["x"], 0.8).isEmpty()


def test_media_regression_finds_planted_effects(spark):
    from tillwise.operators import learning as ml
    rng = np.random.default_rng(2)
    spend = rng.uniform(0, 10, size=(200, 2))
    memory, rows = np.zeros(2), []
    for d, x in enumerate(spend):
        memory = x + 0.5 * memory
        rows.append((d, float(x[0]), float(x[1]), float(3 * memory[0] - memory[1] + 7)))
    coefs, _ = ml.mmm_regression(spark.createDataFrame(rows, "day int, tv double, web double, sales double"), ["tv", "web"], "sales")
    got = {r.term: r.coefficient for r in coefs.collect()}
    assert abs(got["tv"] - 3) < 1e-6 and abs(got["web"] + 1) < 1e-6 and abs(got["intercept"] - 7) < 1e-5


def test_virtual_ensemble_stages_and_bounds(spark, tmp_path):
    import tempfile
    rows = [(float(i % 7), float(i % 5), float((i % 7) * 2 + (i % 5))) for i in range(300)]
    df = md.assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"])
    model = md.gbt_regressor(max_iter=12, step=0.3).fit(df)
    out = md.virtual_ensemble(df, model, ["a", "b"], str(tmp_path), k=2).collect()
    full = {(r.a, r.b): r.prediction for r in model.transform(df).collect()}
    for r in out[:50]:
        assert r.lcb <= r.pred_virt <= r.ucb
        # the last stage (n - 1) is the full model prediction
        assert abs(r.pred[-1] - full[(r.a, r.b)]) < 1e-9


def test_feasible_plan_repair_and_loss_properties(spark):
    from tillwise.operators import governance as gov
    from tillwise.operators import pricing as pr
    from tillwise.plans import demand
    from tillwise.sources.fixtures import fx_demand_orders, fx_price_candidates, fx_sku_day
    d = gov.enrich(fx_sku_day(spark, SF_SMALL))
    assert d.where((F.col("feasible_units") > F.col("stock")) | (F.col("feasible_units") < 0)).count() == 0
    assert d.where(F.col("lost_sales_units") < 0).count() == 0
    cm = pr.candidate_metrics(fx_price_candidates(spark, SF_SMALL))
    plan0 = pr.plan_max_gmv(cm)
    g0, w0 = pr.totals(plan0)
    for target in (0.18, 0.22, 0.5):
        plan, meta = pr.plan_repair(cm, plan0, target)
        g, w = pr.totals(plan)
        assert pr.wm_of(g, w) >= pr.wm_of(g0, w0) - 1e-12
        if meta["status"] == "feasible_after_repairs":
            assert pr.wm_of(g, w) >= target
    losses = demand.baseline_evaluation(fx_demand_orders(spark, SF_SMALL))
    assert losses.where(F.col("avg_quantile_loss") < 0).count() == 0
    assert mt.losses_ok(losses).first().losses_ok


def test_near_duplicates_group_copies_not_strangers(spark):
    from tillwise.operators import similarity as sim
    base = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"z{i}" for i in range(200))
    docs = [(1, base), (2, base), (3, base + " extra"), (4, other), (5, base)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    comp = {r.doc_id: r.component for r in sim.near_duplicate_groups(df).collect()}
    assert comp[1] == comp[2] == comp[3] == comp[5] == 1
    assert comp[4] == 4
    links = sim.match_items(df).collect()
    assert all(r.match_id == 1 for r in links if r.doc_id in (2, 3, 5))
