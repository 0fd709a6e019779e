"""Restocking, delivery and stock-service table maths (M19-M22, M24-M26,
K14, B11, C9).

Greedy restocking (M20) keeps only the first row per SKU in score order
(cost is constant per SKU and the budget only shrinks, so later rows of a SKU
can never be funded) and then fills the budget in rounds of prefix sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.cells import runs
from tillwise.functions.numeric import half_even
from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.session import reliable_checkpoint

# Weeks and percentiles every restock product must carry
REQUIRED_WEEKS = (1, 2, 3, 4)
REQUIRED_PERCENTILES = (5, 10, 25, 50, 75, 90, 95)
GOALS = ("profit", "revenue")


def check_restock_args(budget, weeks: int, goal: str) -> None:
    """Argument checks before any plan is built."""
    if budget is None or budget <= 0:
        raise ValueError("Budget must be a positive integer")
    if weeks not in REQUIRED_WEEKS:
        raise ValueError("Weeks must be between 1 and 4")
    if goal not in GOALS:
        raise ValueError("Optimization goal must be 'profit' or 'revenue'")


def validate_restock(df: DataFrame) -> DataFrame:
    """Violations per rule (rule, n_violations) in one pass; the
    week / percentile completeness test is a set difference per SKU."""
    per_sku = df.groupBy("sku_id").agg(
        F.first("price").alias("price"), F.first("cost").alias("cost"),
        F.first("current_stock").alias("current_stock"), F.first("storage_time").alias("storage_time"),
        F.collect_set("weeks").alias("wk"), F.collect_set(F.struct("weeks", "percentile")).alias("wp"))
    need_wp = F.array(*[F.struct(F.lit(w).alias("weeks"), F.lit(p).alias("percentile"))
                        for w in REQUIRED_WEEKS for p in REQUIRED_PERCENTILES])
    missing_w = F.size(F.array_except(F.array(*[F.lit(w) for w in REQUIRED_WEEKS]), F.col("wk")))
    missing_p = F.size(F.array_except(need_wp.cast("array<struct<weeks:int,percentile:int>>"),
                                      F.col("wp").cast("array<struct<weeks:int,percentile:int>>")))
    rules = {
        "price_le_0": F.col("price") <= 0, "cost_le_0": F.col("cost") <= 0,
        "price_lt_cost": F.col("price") < F.col("cost"), "stock_lt_0": F.col("current_stock") < 0,
        "storage_time_le_0": F.col("storage_time") <= 0, "missing_weeks": missing_w > 0,
        "missing_percentiles": missing_p > 0,
    }
    counts = per_sku.agg(*[F.count_if(c).alias(k) for k, c in rules.items()])
    stack = ", ".join(f"'{k}', {k}" for k in rules)
    return counts.selectExpr(f"stack({len(rules)}, {stack}) as (rule, n_violations)")


def restock_scores(df: DataFrame, weeks: int) -> DataFrame:
    """One row per (sku, percentile) with something to buy, scores and
    totals. Input: the exploded restock table (sku_id, weeks, percentile,
    demand, price, cost, current_stock, storage_time)."""
    x = df.where(F.col("weeks") == weeks)
    dtb = F.greatest(F.col("demand") - F.col("current_stock"), F.lit(0))
    x = x.select("sku_id", "percentile", dtb.alias("demand_to_buy"), "price", "cost", "storage_time")
    x = x.where(F.col("demand_to_buy") > 0)
    risk = 1 - F.col("percentile") / 100.0
    storage = F.log10(F.col("storage_time").cast("double"))
    return x.select(
        "sku_id", "percentile", "demand_to_buy", "price", "cost",
        ((F.col("price") - F.col("cost")) * F.col("demand_to_buy")).alias("tot_profit"),
        (F.col("price") * F.col("demand_to_buy")).alias("tot_revenue"),
        (F.col("cost") * F.col("demand_to_buy")).alias("tot_cost"),
        storage.alias("storage_score"), risk.alias("oos_risk"),
        (((F.col("price") - F.col("cost")) / F.col("cost")) * risk * storage).alias("profit_score"),
        ((F.col("price") / F.col("cost")) * F.col("demand_to_buy") * risk * storage).alias("revenue_score"))


def first_choice(scores: DataFrame, goal: str) -> DataFrame:
    """Per SKU the row that comes first in (score desc, percentile asc)."""
    score = f"{goal}_score"
    cols = scores.columns
    g = scores.groupBy("sku_id").agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(score), -F.col("percentile"))).alias("_r"))
    return g.select("_r.*")


def _buy_in_order(cand: DataFrame, budget: float, order: str) -> DataFrame:
    """Rows of ``cand`` (cost, demand_to_buy, ...) with ``allocated_qty`` > 0:
    in falling ``order`` (then sku_id) each gets ``min(demand, floor(left / cost))``.

    Phases, each at least halving what is left. With R left, a row of cost up
    to R/2 is always affordable until R/2 is spent, and a dearer row, once one
    can be afforded, brings the rest below R/2. So a phase ends at the first
    row where the running sum of full small purchases reaches R/2 or a dear row
    is affordable; all small rows before it are bought in full, all dear ones
    before it skipped. There are at most log2(budget / smallest cost) phases of
    two aggregations each over one range-partitioned, checkpointed table, at
    every size; the result is one pass over it.
    """
    spark = cand.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("_key"), F.col("sku_id")]
    base = cand.withColumn("_key", -F.col(order)).where((F.col("cost") > 0) & (F.col("demand_to_buy") > 0))
    base = reliable_checkpoint(base.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()))
    full = F.col("cost") * F.col("demand_to_buy")
    left, after, phases, last = float(budget), None, F.lit(False), []
    while left > 0:
        behind = F.lit(True) if after is None else (F.col("_key") > after[0]) | ((F.col("_key") == after[0]) & (F.col("sku_id") > after[1]))
        live = base.where(behind & (F.col("cost") <= left))
        small = F.col("cost") <= left / 2
        spent = live.groupBy("_range").agg(F.sum(F.when(small, full).otherwise(0.0)).alias("s"))
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
        offsets = spent.select("_range", F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("_before"))
        run = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
        so_far = F.col("_before") + F.sum(F.when(small, full).otherwise(0.0)).over(run)
        seen = live.join(F.broadcast(offsets), "_range").withColumn("_so_far", so_far)
        stops = F.when(small, F.col("_so_far") >= left / 2).otherwise(F.col("cost") <= left - F.col("_so_far"))
        stop = seen.where(stops).agg(F.min(F.struct("_key", "sku_id", "cost", "demand_to_buy", "_so_far")).alias("r")).first()["r"]
        inside = behind & (F.col("cost") <= left / 2)
        if stop is None:
            phases = phases | inside
            break
        ahead = (F.col("_key") < stop["_key"]) | ((F.col("_key") == stop["_key"]) & (F.col("sku_id") < stop["sku_id"]))
        phases = phases | (inside & ahead)
        cost, demand = stop["cost"], stop["demand_to_buy"]
        left -= stop["_so_far"] - (cost * demand if cost <= left / 2 else 0.0)
        qty = min(demand, math.floor(left / cost))
        if qty > 0:
            last.append((stop["sku_id"], float(qty)))
            left -= qty * cost
        after = (stop["_key"], stop["sku_id"])
    parts = F.lit(None).cast("double")
    for sku, qty in last:
        parts = F.when(F.col("sku_id") == sku, F.lit(qty)).otherwise(parts)
    qty = F.when(phases, F.col("demand_to_buy").cast("double")).otherwise(parts)
    return base.withColumn("allocated_qty", qty).where(F.col("allocated_qty") > 0).drop("_key", "_range")


def restock_greedy(scores: DataFrame, budget: float, goal: str = "profit") -> DataFrame:
    """Greedy budget allocation in (score desc, sku asc) order; see
    ``_buy_in_order``."""
    score = f"{goal}_score"
    cand = first_choice(scores, goal).select("sku_id", "percentile", "price", "cost", "demand_to_buy",
                                             F.col(score).alias("score"))
    out = _buy_in_order(cand, budget, "score").select(
        F.col("sku_id").cast("long"), F.col("percentile").cast("long"), "price", "cost", "allocated_qty")
    out = out.select("*", (F.col("allocated_qty") * F.col("cost")).alias("allocated_budget"),
                     (F.col("allocated_qty") * (F.col("price") - F.col("cost"))).alias("expected_profit"),
                     (F.col("allocated_qty") * F.col("price")).alias("expected_revenue"))
    return out.orderBy(F.col("allocated_budget").desc(), F.col("sku_id").asc())


def _hull_steps(base: DataFrame) -> DataFrame:
    """Steps of every SKU's upper hull of (spent, worth): from buying nothing,
    over some percentiles' whole demands, to the most worthwhile one. Slopes of
    a SKU never rise. A group holds the percentiles of one SKU."""
    point = F.struct((F.col("cost") * F.col("demand_to_buy")).alias("c"), (-F.col("s") * F.col("demand_to_buy")).alias("loss"),
                     "percentile", "price", "cost", "demand_to_buy", "s")
    per_sku = base.groupBy("sku_id").agg(F.array_sort(F.collect_list(point)).alias("p"))

    def worth(x):
        return -x["loss"]

    def slope(x, y):
        return (worth(y) - worth(x)) / (y["c"] - x["c"])

    # a point counts if nothing cheaper (or as cheap and sorted before it) is worth as much
    useful = F.filter("p", lambda x, i: worth(x) > F.greatest(
        F.lit(0.0), F.coalesce(F.array_max(F.transform(F.slice("p", F.lit(1), i), worth)), F.lit(0.0))))
    rising = per_sku.withColumn("p", useful)

    def on_hull(x, i):
        before = F.least(worth(x) / x["c"], F.array_min(F.transform(F.slice("p", F.lit(1), i), lambda y: slope(y, x))))
        after = F.array_max(F.transform(F.slice("p", i + 2, F.size("p")), lambda y: slope(x, y)))
        return before > F.coalesce(after, F.lit(0.0))

    hull = rising.withColumn("p", F.filter("p", on_hull))

    def step(x, i):
        prev = F.get("p", i - 1)
        dc, dv = x["c"] - F.coalesce(prev["c"], F.lit(0.0)), worth(x) - F.coalesce(worth(prev), F.lit(0.0))
        return F.struct(x.alias("to"), prev.alias("from"), dc.alias("dc"), dv.alias("dv"), (dv / dc).alias("slope"))

    steps = hull.withColumn("p", F.transform("p", step))
    falling = F.transform("p", lambda x, i: F.struct(
        x["to"].alias("to"), x["from"].alias("from"), x["dc"].alias("dc"), x["dv"].alias("dv"),
        F.array_min(F.transform(F.slice("p", F.lit(1), i + 1), lambda y: y["slope"])).alias("slope")))
    return steps.select("sku_id", F.explode(falling).alias("x")).select("sku_id", "x.*")


def restock_lagrangian(scores: DataFrame, budget: float, goal: str = "profit") -> tuple:
    """M21 (re-aimed): the integer programme max Σ score·qty, Σ cost·qty <=
    budget, one percentile per SKU, qty <= demand.

    Its relaxation is solved exactly: of each SKU only the upper hull of (spent,
    worth) matters, the steps of all hulls are funded by falling slope, and one
    prefix sum finds the step at which the budget ends. The plan takes all steps
    before that one; what is left goes to the SKU of that step, if it has more to
    gain there, and then to SKUs without a purchase by falling score per cost, in
    full or in part, until none of them is affordable.

    Rows without a cost, a demand or a positive score are never bought. Returns
    (allocation DataFrame, info dict: value, spent, dual_bound = optimum of the
    relaxation, lambda = slope of the last step, gap). Scores are rounded to 4
    decimals like the reference model. ``scores`` has one row per SKU and percentile.
    """
    score = half_even(F.col(f"{goal}_score"), 4)
    base = scores.select("sku_id", "percentile", "price", "cost", "demand_to_buy", score.alias("s")).where(
        "cost > 0 and demand_to_buy > 0 and s > 0")
    key = F.struct((-F.col("slope")).alias("k"), "sku_id", F.col("to.c").alias("c"))
    steps = reliable_checkpoint(ordered_prefix_sums(
        _hull_steps(base), [-F.col("slope"), F.col("sku_id"), F.col("to.c")], {"sum_c": F.col("dc")}).withColumn("key", key))
    end = steps.where(F.col("sum_c") > budget).agg(F.min(F.struct("key", "slope", "sku_id", "to", "from")).alias("r")).first()["r"]
    funded = steps if end is None else steps.where(F.col("key") < F.struct(
        F.lit(end["key"]["k"]).alias("k"), F.lit(end["sku_id"]).alias("sku_id"), F.lit(end["key"]["c"]).alias("c")))
    full = funded.agg(F.sum("dc").alias("c"), F.sum("dv").alias("v")).first()
    spent, value = float(full["c"] or 0.0), float(full["v"] or 0.0)
    lam = float(end["slope"]) if end else 0.0
    bound = value + lam * max(budget - spent, 0.0)
    chosen = funded.groupBy("sku_id").agg(F.max_by("to", "to.c").alias("r")).select("sku_id", "r.*").withColumn(
        "qty", F.col("demand_to_buy").cast("double"))
    cols = ["sku_id", "percentile", "price", "cost", "qty", "s"]
    left, parts = max(budget - spent, 0.0), []
    if end and end["from"] is not None:  # the SKU of the last step has a smaller purchase already
        old, new = end["from"], end["to"]
        qty = min(new["demand_to_buy"], math.floor((left + old["c"]) / new["cost"]))
        if qty * new["s"] > -old["loss"]:
            one = chosen.where(F.col("sku_id") == end["sku_id"]).select(
                "sku_id", *[F.lit(new[c]).alias(c) for c in ("percentile", "price", "cost")],
                F.lit(float(qty)).alias("qty"), F.lit(new["s"]).alias("s"))
            parts.append(one)
            chosen = chosen.where(F.col("sku_id") != end["sku_id"])
            left = max(left + old["c"] - qty * new["cost"], 0.0)
    firsts = steps.where(F.col("from").isNull()).select("sku_id", "to.*")
    bought = funded.select("sku_id").distinct()
    extra = firsts.join(bought, "sku_id", "left_anti").withColumn("_worth", F.col("s") / F.col("cost"))
    parts.append(_buy_in_order(extra, left, "_worth").withColumn("qty", F.col("allocated_qty")).select(*cols))
    alloc = chosen.select(*cols)
    for p in parts:
        alloc = alloc.unionByName(p)
    alloc = reliable_checkpoint(alloc)
    val = alloc.agg(F.sum(F.col("s") * F.col("qty")).alias("v"), F.sum(F.col("cost") * F.col("qty")).alias("c")).first()
    info = {"value": float(val["v"] or 0.0), "spent": float(val["c"] or 0.0), "dual_bound": bound,
            "lambda": lam, "gap": bound - float(val["v"] or 0.0)}
    return alloc, info


# ------------------------------------------------------------ M22 delivery
DELIVERY_OUT = T.StructType([
    T.StructField("product", T.LongType()), T.StructField("marketplace", T.StringType()),
    T.StructField("units", T.LongType()), T.StructField("status", T.StringType())])


def least_totals(sizes: list[int]) -> list[int | None]:
    """By residue modulo the smallest size, the least total that bundles of these sizes can make.

    Of one residue, just this total and all larger ones can be made. For each further size the
    residues are gone through in the circles in which adding it leads, twice each."""
    modulus = min(sizes)
    least: list[int | None] = [None] * modulus
    least[0] = 0
    for size in sizes:
        circles = math.gcd(size, modulus)
        for start in range(circles):
            at = start
            for _ in range(2 * modulus // circles):
                after = (at + size) % modulus
                if least[at] is not None and (least[after] is None or least[at] + size < least[after]):
                    least[after] = least[at] + size
                at = after
    return least


def deliver(stock: int, sizes: list[int], bounds: list[tuple[int, int]]) -> list[int] | None:
    """Units for each marketplace, of greatest sum within ``stock``; None if there are none.

    What a marketplace can take of one residue is an arithmetic progression whose step is the
    smallest size, and so is any sum of such choices. So it is enough to know, for each residue and
    greatest sum, the least sum: there are few of these, however large the stock."""
    sizes = sorted({s for s in sizes if s > 0})
    step = sizes[0] if sizes else 1
    least = least_totals(sizes) if sizes else [0]
    # (residue, greatest sum) -> (least sum, progressions chosen)
    state: dict[tuple[int, int], tuple[int, tuple]] = {(0, 0): (0, ())}
    for low, high in bounds:
        high = min(high, stock)
        options = []
        for residue, first in enumerate(least):
            if first is None:
                continue
            first = max(first, low + (residue - low) % step)
            last = high - (high - residue) % step if sizes else min(high, 0)
            if first <= last:
                options.append((residue, first, last))
        after: dict[tuple[int, int], tuple[int, tuple]] = {}
        for (residue, most), (few, chosen) in state.items():
            for r, first, last in options:
                key, total = ((residue + r) % step, most + last), few + first
                if total <= stock and (key not in after or total < after[key][0]):
                    after[key] = total, (*chosen, (first, last))
        state = after
    best = max(((min(most, stock - (stock - residue) % step), chosen, few) for (residue, most), (few, chosen) in state.items()), default=None)
    if best is None:
        return None
    units, left = [first for first, _ in best[1]], best[0] - best[2]
    for k in range(len(units) - 1, -1, -1):  # the last marketplaces take as much as they can
        more = min(best[1][k][1] - units[k], left)
        units[k] += more
        left -= more
    return units


def _delivered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("product", "marketplace", "min_demand", "max_demand", "stock", "small", "middle", "large")
    for table, cut in runs(batches, ["product"]):
        product, place, low, high, stock, *sizes = (table.column(c).to_pylist() for c in names)
        units, status = [], []
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            found = deliver(stock[lo], [s[lo] for s in sizes], list(zip(low[lo:hi], high[lo:hi])))
            units += found or [0] * (hi - lo)
            status += ["infeasible" if found is None else "optimal"] * (hi - lo)
        yield pa.RecordBatch.from_arrays([pa.array(product, pa.int64()), pa.array(place, pa.string()), pa.array(units, pa.int64()),
                                          pa.array(status, pa.string())], names=["product", "marketplace", "units", "status"])


def bundle_delivery(df: DataFrame) -> DataFrame:
    """Per product, integer bundles (three sizes) per marketplace inside
    its [min, max] demand, total within stock, units maximised. Products do not
    interact, so each is an exact small search by residues of the smallest
    size; memory does not depend on the stock, and a product has at most a
    handful of marketplaces, so its rows are bounded."""
    whole = df.select(F.col("product").cast("long"), F.col("marketplace").cast("string"),
                      *[F.floor(c).cast("long").alias(c) for c in ("min_demand", "max_demand", "stock", "small", "middle", "large")])
    return (whole.repartition("product").sortWithinPartitions("product", "marketplace")
            .mapInArrow(_delivered, DELIVERY_OUT))


# --------------------------------------------------------- K14 inventory KPIs
def inventory_kpis(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """GMV, gross margin (+%), average inventory, GMROI, turnover and
    turnover days; each rounded half-even to 2 decimals and fed rounded into
    the next, with the zero guards as coded."""
    g = df.groupBy(*(by or [])).agg(
        F.sum(F.col("price") * F.col("quantity_sold")).alias("_rev"),
        F.sum(F.col("cost") * F.col("quantity_sold")).alias("_cogs"),
        F.sum((F.col("inventory_start") + F.col("inventory_end")) / 2).alias("_inv"))
    r2 = lambda c: half_even(c, 2)
    margin_raw = F.col("_rev") - F.col("_cogs")
    g = g.select(*(by or []), r2(F.col("_rev")).alias("gmv"), r2(margin_raw).alias("gross_margin"),
                 F.when(F.col("_rev") == 0, F.lit(0.0)).otherwise(r2(margin_raw / F.col("_rev") * 100))
                 .alias("gross_margin_pct"),
                 r2(F.col("_inv")).alias("avg_inventory"), "_cogs")
    g = g.withColumn("gmroi", F.when(F.col("avg_inventory") == 0, F.lit(0.0)).otherwise(
        r2(F.col("gross_margin") / F.col("avg_inventory"))))
    g = g.withColumn("turnover", F.when(F.col("avg_inventory") == 0, F.lit(0.0)).otherwise(
        r2(F.col("_cogs") / F.col("avg_inventory"))))
    g = g.withColumn("turnover_days", F.when(F.col("turnover") == 0, F.lit(0.0)).otherwise(
        r2(F.lit(365.0) / F.col("turnover"))))
    return g.drop("_cogs")


# --------------------------------------------------- M24-M26, C9 stock service
def forecast_for(requests: DataFrame, predictions: DataFrame, horizon: int, confidence_pct: int,
                 how: str = "inner") -> DataFrame:
    """Attach the prediction column ``pred_{h}d_q{pct}`` to each request
    row by sku_id (a batch join instead of per-request lookups)."""
    col = f"pred_{horizon}d_q{confidence_pct}"
    p = predictions.select("sku_id", F.col(col).alias("forecast"))
    return requests.join(p, "sku_id", how)


def order_quantity(requests: DataFrame, predictions: DataFrame, horizon: int = 7, confidence_pct: int = 90,
                   rounding: str = "truncate") -> DataFrame:
    """max(0, forecast - stock); ``truncate`` (int()), ``ceil`` or ``none``."""
    j = forecast_for(requests, predictions, horizon, confidence_pct)
    raw = F.greatest(F.lit(0.0), F.col("forecast") - F.col("stock"))
    q: Column = {"truncate": raw.cast("long"), "ceil": F.ceil(raw), "none": raw}[rounding]
    return j.select("sku_id", "stock", "forecast", q.alias("quantity"))


def stock_forecast(requests: DataFrame, predictions: DataFrame, horizon: int = 7,
                   confidence_pct: int = 50) -> DataFrame:
    """max(0, stock - forecast)."""
    j = forecast_for(requests, predictions, horizon, confidence_pct)
    return j.select("sku_id", "stock", "forecast",
                    F.greatest(F.lit(0.0), F.col("stock") - F.col("forecast")).alias("stock_forecast"))


def low_stock_list(requests: DataFrame, predictions: DataFrame, horizon: int = 7,
                   confidence_pct: int = 50) -> DataFrame:
    """SKUs whose stock is below the forecast; unknown SKUs are skipped
    by the inner join."""
    j = forecast_for(requests, predictions, horizon, confidence_pct)
    return j.where(F.col("stock") < F.col("forecast")).select("sku_id", "stock", "forecast")
