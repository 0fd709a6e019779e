"""Price plans under a margin guardrail.

Per-SKU choices are single aggregations with ``max_by`` / ``min_by`` over
struct keys (partial aggregation, no sort). The greedy repair is evaluated as
running sums over the repair order (7.4 of the survey) on range partitions.

Tie rules (the reference leaves them to an unstable sort): plan argmax ties
after (gmv, margin) go to the smaller price; repair ties go to the larger
margin gain, then the smaller price, then the SKU; ``first``-row argmax uses
the caller's row order columns.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.session import measured_checkpoint, reliable_checkpoint
from tillwise.schemas import require_columns

REQUIRED = ["sku", "category", "cost", "price", "qty"]

# Data-quality rule names of the margin job, in rule order
DQ_RULES = ("cost_is_nan", "price_is_nan", "qty_is_nan", "price_le_0", "qty_lt_0", "cost_lt_0")

# Action text of the margin report
ACTION_ISSUE = "negative_margin_high_penetration"
ACTION_TEXT = "Review promo depth / negotiate cost / adjust price floor / replace SKU in promo set"

# Alert texts of the margin report, by code
ALERT_TEXTS = {
    "empty_plan": "No valid rows after data quality filtering.",
    "infeasible_or_not_met": "weighted_margin=%.4f < target=%.4f.",
    "low_margin_buffer": "buffer=%.2fpp. Risk of missing target due to forecast error / cost change.",
    "loss_leader_penetration": "Negative margin SKUs have high GMV penetration. Check pricing strategy and supplier conditions.",
}


def extract_candidates(df: DataFrame) -> DataFrame:
    """B1: six columns, ``qty IS NOT NULL`` (pushed into the scan)."""
    return df.select("sku", "category", "cost", "price", "qty", "scenario_id").where(F.col("qty").isNotNull())


def filter_scope(df: DataFrame, category: str | None = None, scenario: str | None = None) -> DataFrame:
    """Optional category / scenario filter, compared as strings."""
    require_columns(df, REQUIRED, "price candidates")
    if category is not None:
        df = df.where(F.col("category").cast("string") == F.lit(str(category)))
    if scenario is not None:
        if "scenario_id" not in df.columns:
            raise ValueError("scenario_id column is required when a scenario is given")
        df = df.where(F.col("scenario_id").cast("string") == F.lit(str(scenario)))
    return df


def coerce_numeric(df: DataFrame, cols=("cost", "price", "qty")) -> DataFrame:
    """Non-numeric -> NULL (``try_cast``; a plain cast throws under ANSI)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.expr(f"try_cast(`{c}` as double)"))
    return out


def _rule_flags() -> list[tuple[str, Column]]:
    cost, price, qty = F.col("cost"), F.col("price"), F.col("qty")
    def missing(c):
        return c.isNull() | F.isnan(c.cast("double"))
    return [("cost_is_nan", missing(cost)), ("price_is_nan", missing(price)), ("qty_is_nan", missing(qty)),
            ("price_le_0", price <= 0), ("qty_lt_0", qty < 0), ("cost_lt_0", cost < 0)]


def dq_report(df: DataFrame) -> DataFrame:
    """One row per violated rule per input row (single pass, explode)."""
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in _rule_flags()]))
    return df.select("*", F.explode(reasons).alias("dq_reason"))


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows passing all six rules."""
    ok = None
    for _, cond in _rule_flags():
        c = ~F.coalesce(cond, F.lit(True))
        ok = c if ok is None else ok & c
    return df.where(ok)


def dedup_candidates(df: DataFrame, order: str = "scenario_id") -> DataFrame:
    """One row per (sku, category, cost, price, qty); the survivor is the
    one with the smallest ``order`` value (deterministic, one aggregation)."""
    keys = ["sku", "category", "cost", "price", "qty"]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return g.select(*keys, "_r.*")


def candidate_metrics(df: DataFrame) -> DataFrame:
    """M9: gmv, margin, gross profit per candidate."""
    return (df.withColumn("gmv", F.col("price") * F.col("qty"))
            .withColumn("margin", (F.col("price") - F.col("cost")) / F.col("price"))
            .withColumn("gp", (F.col("price") - F.col("cost")) * F.col("qty")))


def _by_key(side: DataFrame) -> DataFrame:
    """One side of a join with as many rows as SKUs: both sides go by key. Planned by
    the bytes of a well packed file it would be collected to be broadcast."""
    return side.hint("merge")


def _argmax(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """the row with the largest ``struct(order)`` per key."""
    cols = df.columns
    g = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order)).alias("_r"))
    return g.select("_r.*")


def plan_max_gmv(df: DataFrame) -> DataFrame:
    """Per SKU the max-GMV candidate (ties: higher margin, smaller price)."""
    return _argmax(df, "sku", [F.col("gmv"), F.col("margin"), -F.col("price")])


def plan_max_margin(df: DataFrame) -> DataFrame:
    """Per SKU the max-margin candidate (ties: higher GMV, smaller price)."""
    return _argmax(df, "sku", [F.col("margin"), F.col("gmv"), -F.col("price")])


def first_argmax(df: DataFrame, key: str, value: str, row_order: list[Column]) -> DataFrame:
    """first row (by ``row_order``) holding the maximum of ``value``.

    ``row_order`` is ascending; the negated rank trick keeps one aggregation.
    """
    w_first = [-c if not isinstance(c, str) else -F.col(c) for c in row_order]
    return _argmax(df, key, [F.col(value), *w_first])


def argmax_all_ties(df: DataFrame, key: str = "sku", value: str = "price", out: str = "is_selected") -> DataFrame:
    """Mark every row at its group's maximum: a grouped max
    (map-side combined) joined back by key, not a window holding a whole
    group in one task."""
    cols = df.columns
    mx = df.groupBy(F.col(key).alias("_k")).agg(F.max(value).alias("_max"))
    j = df.join(_by_key(mx), df[key].eqNullSafe(mx["_k"]), "left")
    return j.select(*cols, (F.col(value) == F.col("_max")).alias(out))


def totals(plan: DataFrame) -> tuple[float, float]:
    """(Σgmv, Σgmv·margin) of a plan: one bounded scalar row."""
    r = plan.agg(F.sum("gmv").alias("g"), F.sum(F.col("gmv") * F.col("margin")).alias("w")).first()
    return float(r["g"] or 0.0), float(r["w"] or 0.0)


def wm_of(g: float, w: float) -> float:
    return 0.0 if g <= 0 else w / g


PLAN_COLS = ["sku", "category", "price", "cost", "qty", "gmv", "margin", "gp"]


def repair_candidates(cands: DataFrame, plan: DataFrame) -> DataFrame:
    """M11 step 1: per SKU the best higher-margin switch.

    score = -1e9 when GMV does not fall, else GMV loss / margin gain; best =
    lowest score, ties larger margin gain, then smaller price.
    """
    cur = plan.select("sku", *[F.col(c).alias(f"cur_{c}") for c in ("gmv", "gp", "margin")])
    j = cands.join(_by_key(cur), "sku")
    d_gmv = F.col("gmv") - F.col("cur_gmv")
    d_margin = F.col("margin") - F.col("cur_margin")
    j = j.select("*", d_gmv.alias("delta_gmv"), (F.col("gp") - F.col("cur_gp")).alias("delta_gp"),
                 d_margin.alias("delta_margin")).where(F.col("delta_margin") > 0)
    score = F.when(F.col("delta_gmv") >= 0, F.lit(-1e9)).otherwise(
        F.greatest(-F.col("delta_gmv"), F.lit(0.0)) / F.col("delta_margin"))
    j = j.withColumn("repair_score", score)
    # weighted-margin numerator change: gmv*margin, the reference's own weights
    j = j.withColumn("delta_w", F.col("gmv") * F.col("margin") - F.col("cur_gmv") * F.col("cur_margin"))
    keep = ["price", "cost", "qty", "gmv", "margin", "gp", "delta_gmv", "delta_gp", "delta_margin",
            "repair_score", "delta_w"]
    best = j.groupBy("sku").agg(F.min_by(F.struct(*[F.col(c) for c in keep]),
                                         F.struct(F.col("repair_score"), -F.col("delta_margin"),
                                                  F.col("price"))).alias("_r"))
    return best.select("sku", *[F.col(f"_r.{c}").alias(c if c.startswith(("delta", "repair")) else f"new_{c}")
                                for c in keep])


def plan_repair(cands: DataFrame, plan: DataFrame, target: float) -> tuple[DataFrame, dict]:
    """Apply best repairs in score order until the weighted margin
    reaches ``target``; returns the repaired plan and its meta dict.

    The weighted margin after k repairs is (W0 + Σ Δw) / (G0 + Σ Δgmv), so the
    stopping point k* is the first position where that ratio meets the target.
    """
    g0, w0 = totals(plan)
    meta = {"status": "ok", "iterations": 0, "repairs_applied": 0, "target_margin": target}
    plan = plan.select(*PLAN_COLS)
    if wm_of(g0, w0) >= target:
        meta["status"] = "already_feasible"
        return plan.withColumn("repaired", F.lit(False)), meta
    rep = repair_candidates(cands, plan)
    order = [F.col("repair_score"), F.col("delta_margin").desc(), F.col("new_price"), F.col("sku")]
    cum = ordered_prefix_sums(rep, order, {"cum_gmv": F.col("delta_gmv"), "cum_w": F.col("delta_w")},
                              row_number="repair_rank")
    den = F.lit(g0) + F.col("cum_gmv")
    wm = F.when(den <= 0, F.lit(0.0)).otherwise((F.lit(w0) + F.col("cum_w")) / den)
    stats = cum.agg(F.count(F.lit(1)).alias("n"),
                    F.min(F.when(wm >= target, F.col("repair_rank"))).alias("k")).first()
    n = int(stats["n"])
    if n == 0:
        meta["status"] = "infeasible_no_repairs"
        return plan.withColumn("repaired", F.lit(False)), meta
    k = stats["k"]
    if k is None:
        k, meta["status"] = n, "still_infeasible_after_repairs"
    else:
        meta["status"] = "feasible_after_repairs"
    meta["iterations"] = meta["repairs_applied"] = int(k)
    applied = cum.where(F.col("repair_rank") <= k).select(
        "sku", *[F.col(f"new_{c}") for c in ("price", "cost", "qty", "gmv", "margin", "gp")])
    j = plan.join(_by_key(applied), "sku", "left")
    hit = F.col("new_price").isNotNull()
    out = j.select("sku", "category",
                   *[F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
                     for c in ("price", "cost", "qty", "gmv", "margin", "gp")],
                   hit.alias("repaired"))
    # the repaired plan feeds several reports; materialise it once
    return reliable_checkpoint(out), meta


def plan_summary(plan: DataFrame, target: float, by: list[str] | None = None) -> DataFrame:
    """Weighted margin, buffer in p.p., totals and SKU count."""
    tot = F.sum("gmv")
    wm = F.when(F.coalesce(tot, F.lit(0.0)) <= 0, F.lit(0.0)).otherwise(
        F.sum(F.col("gmv") * F.col("margin")) / tot)
    g = plan.groupBy(*(by or [])).agg(
        wm.alias("weighted_margin"), F.sum("gmv").alias("total_gmv"), F.sum("gp").alias("total_gp"),
        F.countDistinct("sku").alias("n_skus"))
    return g.select(*(by or []), F.lit(float(target)).alias("target_margin"), "weighted_margin",
                    ((F.col("weighted_margin") - F.lit(float(target))) * 100.0).alias("margin_buffer_pp"),
                    "total_gmv", "total_gp", "n_skus")


def plan_contribution(plan: DataFrame) -> DataFrame:
    """GMV penetration and weighted-margin contribution per SKU."""
    total = float(plan.agg(F.sum("gmv")).first()[0] or 0.0)
    pen = (F.col("gmv") / F.lit(total)) if total > 0 else F.lit(0.0)
    return (plan.withColumn("gmv_penetration", pen)
            .withColumn("weighted_margin_contribution", F.col("gmv_penetration") * F.col("margin")))


def top_n(contrib: DataFrame, n: int = 20) -> DataFrame:
    """best and worst ``n`` SKUs by contribution (TakeOrdered each)."""
    c = F.col("weighted_margin_contribution")
    best = contrib.orderBy(c.desc(), F.col("sku")).limit(n).withColumn("side", F.lit("support"))
    worst = contrib.orderBy(c.asc(), F.col("sku")).limit(n).withColumn("side", F.lit("damage"))
    return best.unionByName(worst)


def plan_actions(contrib: DataFrame, min_penetration: float = 0.02) -> DataFrame:
    """Negative-margin SKUs with high penetration."""
    return (contrib.where((F.col("margin") < 0) & (F.col("gmv_penetration") >= min_penetration))
            .withColumn("issue", F.lit(ACTION_ISSUE))
            .withColumn("recommended_action", F.lit(ACTION_TEXT))
            .orderBy(F.col("gmv_penetration").desc()))


def _top_ids(contrib: DataFrame, desc: bool, n: int = 10) -> Column:
    c = F.col("weighted_margin_contribution")
    top = contrib.orderBy(c.desc() if desc else c.asc(), F.col("sku")).limit(n)
    key = -c if desc else c
    ordered = top.agg(F.sort_array(F.collect_list(F.struct(key.alias("k"), F.col("sku").alias("s")))).alias("a"))
    return ordered.select(F.array_join(F.transform("a", lambda x: x["s"].cast("string")), ", ").alias("ids"))


def plan_alerts(plan: DataFrame, contrib: DataFrame, target: float) -> DataFrame:
    """Alert lines (level, code, message) as a table."""
    agg = plan.agg(F.count(F.lit(1)).alias("n"), F.sum("gmv").alias("g"),
                   F.sum(F.col("gmv") * F.col("margin")).alias("w"))
    wm = F.when(F.coalesce(F.col("g"), F.lit(0.0)) <= 0, F.lit(0.0)).otherwise(F.col("w") / F.col("g"))
    agg = agg.select("n", wm.alias("wm"))
    risk = contrib.agg(F.count_if((F.col("margin") < 0) & (F.col("gmv_penetration") >= 0.05)).alias("risk"))
    t = F.lit(float(target))
    buf = (F.col("wm") - t) * 100.0

    def line(cond, level, code, msg):
        return F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), msg.alias("message")))

    # three one-row aggregates merged by union + max (no join needed)
    base = agg.select("n", "wm", F.lit(None).cast("long").alias("risk")).unionByName(
        risk.select(F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("wm"), "risk"))
    one = base.agg(F.max("n").alias("n"), F.max("wm").alias("wm"), F.max("risk").alias("risk"))
    alerts = one.select(F.explode(F.array_compact(F.array(
        line(F.col("n") == 0, "ALERT", "empty_plan", F.lit(ALERT_TEXTS["empty_plan"])),
        line((F.col("n") > 0) & (F.col("wm") < t), "ALERT", "infeasible_or_not_met",
             F.format_string(ALERT_TEXTS["infeasible_or_not_met"], F.col("wm"), t)),
        line((F.col("n") > 0) & (buf < 1.0) & (F.col("wm") >= t), "ALERT", "low_margin_buffer",
             F.format_string(ALERT_TEXTS["low_margin_buffer"], buf)),
        line((F.col("n") > 0) & (F.col("risk") > 0), "ALERT", "loss_leader_penetration",
             F.lit(ALERT_TEXTS["loss_leader_penetration"]))))).alias("a")).select("a.*")
    support = _top_ids(contrib, True).select(F.lit("INFO").alias("level"), F.lit("top_support_skus").alias("code"),
                                             F.col("ids").alias("message"))
    damage = _top_ids(contrib, False).select(F.lit("INFO").alias("level"), F.lit("top_damage_skus").alias("code"),
                                             F.col("ids").alias("message"))
    return alerts.unionByName(support).unionByName(damage)


def _tie_swaps(m: DataFrame, start: DataFrame, target: float, row_order: list[Column]) -> DataFrame:
    """Per SKU that may swap: its best-margin GMV tie, the slack the swap adds,
    and the slack from which a candidate of higher margin and lower GMV would
    meet the target first (and end the SKU's trial without a swap)."""
    worth = (F.col("margin") - F.lit(target)) * F.col("gmv")
    cur = start.select("sku", F.col("gmv").alias("_g"), worth.alias("_v"))
    c = m.withColumn("_w", worth).join(_by_key(cur), "sku")
    best = _argmax(c.where(F.col("gmv") == F.col("_g")), "sku", [F.col("margin"), *[-x for x in row_order]])
    tie = best.select("sku", F.col("margin").alias("_tie_margin"), (F.col("_w") - F.col("_v")).alias("_gain"),
                      F.struct(*[F.col(x) for x in m.columns]).alias("_row"))
    ahead = (c.join(_by_key(tie.select("sku", "_tie_margin")), "sku").where(F.col("margin") > F.col("_tie_margin"))
             .groupBy("sku").agg(F.min(F.col("_v") - F.col("_w")).alias("_block")))
    return tie.where(F.col("_gain") > 0).join(_by_key(ahead), "sku", "left").select(
        "sku", "_gain", F.coalesce("_block", F.lit(float("inf"))).alias("_block"), "_row")


def _swaps_taken(swaps: DataFrame, slack: float, sku_type: str, few: int) -> DataFrame | None:
    """SKUs of ``swaps`` (sku, _gain > 0, _block, _range) that swap when tried in order, from a negative ``slack``.

    The first to swap is the first whose own gain closes the gap: one minimum. From then on
    the slack only grows, and a SKU swaps exactly if the slack is below its block. Bounds
    of the slack before each SKU, by prefix sums of what surely and what possibly swapped, decide most
    SKUs at once and tighten round by round. When ``few`` are open, or a round decides less
    than half of them, the open ones stream through one task in order."""
    first = swaps.where((F.lit(slack) + F.col("_gain") >= 0) & (F.lit(slack) < F.col("_block"))).agg(
        F.min(F.struct("sku", "_gain")).alias("r")).first()["r"]
    if first is None:
        return None
    now = slack + first["_gain"]
    state = F.when(F.col("_block") <= now, F.lit(False)).when(F.col("_block") == float("inf"), F.lit(True))
    table = swaps.where(F.col("sku") > first["sku"]).select("sku", "_gain", "_block", "_range", state.alias("_state"))
    inside = Window.partitionBy("_range").orderBy("sku").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    surely = F.when(F.col("_state"), F.col("_gain")).otherwise(0.0)
    maybe = F.when(F.coalesce("_state", F.lit(True)), F.col("_gain")).otherwise(0.0)
    left = None
    while True:
        sums = table.groupBy("_range").agg(F.sum(surely).alias("lo"), F.sum(maybe).alias("hi"))
        offsets = sums.select("_range", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"_{c}") for c in ("lo", "hi")])
        seen = table.join(F.broadcast(offsets), "_range")
        low, high = (F.lit(now) + F.col(c) + F.coalesce(F.sum(x).over(inside), F.lit(0.0)) for c, x in (("_lo", surely), ("_hi", maybe)))
        decided = F.when(F.col("_state").isNotNull(), F.col("_state")).when(F.col("_block") > high, F.lit(True)).when(
            F.col("_block") <= low, F.lit(False))
        table = measured_checkpoint(seen.withColumn("_decided", decided).drop("_lo", "_hi", "_state").withColumnRenamed("_decided", "_state"))
        was, left = left, table.where("_state is null").count()
        if left <= few or (was is not None and 2 * left > was):
            break

    def fold(batches):
        extra = 0.0  # gains of open SKUs that swapped; ``_low`` holds those of the decided ones
        for b in batches:
            kept = []
            for sku, gain, block, low in b.itertuples(index=False):
                if low + extra < block:
                    extra += gain
                    kept.append(sku)
            yield pd.DataFrame({"sku": kept})

    taken = table.where("_state").select("sku").unionByName(swaps.where(F.col("sku") == first["sku"]).select("sku"))
    if left:
        sums = table.groupBy("_range").agg(F.sum(surely).alias("lo"))
        offsets = sums.select("_range", F.coalesce(F.sum("lo").over(before), F.lit(0.0)).alias("_lo"))
        lows = table.join(F.broadcast(offsets), "_range").withColumn(
            "_low", F.lit(now) + F.col("_lo") + F.coalesce(F.sum(surely).over(inside), F.lit(0.0)))
        ordered = lows.where("_state is null").select("sku", "_gain", "_block", "_low")
        taken = taken.unionByName(ordered.coalesce(1).sortWithinPartitions("sku").mapInPandas(fold, f"sku {sku_type}"))
    return reliable_checkpoint(taken)


def price_mask(df: DataFrame, target: float, row_order: list[Column], few: int = 100_000) -> DataFrame:
    """The GMV-max selection if it meets ``target``. Otherwise SKUs are
    tried in order, each with its candidates by falling margin: the first with
    which the whole selection meets the target is taken if GMV does not fall.
    If the target is still missed, the max-margin candidate of every SKU.

    GMV starts at its maximum, so only an exact GMV tie of higher margin can be
    taken. With slack = sum((margin - target) * gmv), SKU s swaps when its gain
    makes the slack non-negative and no candidate of higher margin does so
    before; see ``_swaps_taken``."""
    m = candidate_metrics(df)
    start = first_argmax(m, "sku", "gmv", row_order)
    g, w = totals(start)
    chosen = start
    if wm_of(g, w) < target:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        swaps = _tie_swaps(m, start, target, row_order).repartitionByRange(n, "sku")
        swaps = reliable_checkpoint(swaps.withColumn("_range", F.spark_partition_id()))
        accepted = _swaps_taken(swaps, w - target * g, dict(swaps.dtypes)["sku"], few)
        if accepted is not None:
            chosen = (start.join(_by_key(accepted), "sku", "left_anti").select(*m.columns)
                      .unionByName(swaps.join(_by_key(accepted), "sku", "left_semi").select("_row.*")))
        else:
            chosen = first_argmax(m, "sku", "margin", row_order)
    keys = [c for c in df.columns]
    sel = chosen.select(*keys).withColumn("is_selected", F.lit(True))
    return df.join(_by_key(sel), keys, "left").withColumn("is_selected", F.coalesce("is_selected", F.lit(False)))
