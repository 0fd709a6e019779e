"""Product and unit-economics analytics (title-only items T1-T3, T5-T11,
T13; definitions are the usual textbook ones).

Per-entity windows are partitioned by the entity; the global orderings
needed for quantile scores use range-partitioned running counts instead of a
single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.numeric import safe_div
from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.session import reliable_checkpoint


def _micros(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(col.cast("timestamp"))


# ---------------------------------------------------------------- T1 sessions
def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_minutes: int = 30) -> DataFrame:
    """A new session starts when the user was inactive for more than
    ``gap_minutes``; one row per session with start/end (epoch micros),
    event count and duration in seconds. Per-user order uses the range-split
    keyed sequence, so a user with a third of all events spans many tasks."""
    from tillwise.functions.prefix import keyed_sequence
    e = events.select(F.col(user).alias("_u"), _micros(ts).alias("_t"), F.col("event_id"))
    gap = F.lit(gap_minutes * 60 * 1_000_000)
    new = F.when(F.col("prev__t").isNull() | (F.col("_t") - F.col("prev__t") > gap), 1).otherwise(0)
    s = keyed_sequence(e, "_u", ["_t", "event_id"], ["_t"], {"session_idx": new})
    g = s.groupBy(F.col("_u").alias(user), "session_idx").agg(
        F.min("_t").alias("start_us"), F.max("_t").alias("end_us"), F.count(F.lit(1)).alias("n_events"))
    return g.withColumn("duration_s", (F.col("end_us") - F.col("start_us")) / 1_000_000.0)


# ------------------------------------------------------------------- T2 NPS
def nps(df: DataFrame, score: str, by: list[str] | None = None) -> DataFrame:
    """% promoters (>= 9) minus % detractors (<= 6)."""
    s = F.col(score)
    return df.groupBy(*(by or [])).agg(
        F.count(s).alias("n"),
        (100.0 * (F.avg(F.when(s >= 9, 1.0).otherwise(0.0)) - F.avg(F.when(s <= 6, 1.0).otherwise(0.0))))
        .alias("nps"))


# --------------------------------------------------------- T3 dashboard
def daily_dashboard(df: DataFrame, day: str, value: str, ma_days: int = 7) -> DataFrame:
    """Daily total, trailing moving average and week-over-week change on a
    dense calendar (one row per day; the window runs over days only)."""
    d = df.groupBy(F.col(day).alias("day")).agg(F.sum(value).alias("value"))
    r = d.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    cal = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(r["lo"]), F.lit(r["hi"]))).alias("day"))
    j = cal.join(d, "day", "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    w = Window.orderBy("day")
    prev = F.lag("value", 7).over(w)
    return j.select("day", "value", F.avg("value").over(w.rowsBetween(-(ma_days - 1), 0)).alias("moving_avg"),
                    safe_div(F.col("value") - prev, prev).alias("wow_change"))


# ------------------------------------------------------- T5 / T6 / T8 orders
def month_of(c) -> Column:
    return F.trunc(F.to_date(c), "month")


def arpu_aov(orders: DataFrame) -> DataFrame:
    """T5: revenue per user and per order by month."""
    g = orders.groupBy(month_of("o_orderdate").alias("month")).agg(
        F.sum("o_totalprice").alias("revenue"), F.countDistinct("o_custkey").alias("users"),
        F.count(F.lit(1)).alias("orders"))
    return g.withColumn("arpu", F.col("revenue") / F.col("users")).withColumn(
        "aov", F.col("revenue") / F.col("orders"))


def average_check(orders: DataFrame) -> DataFrame:
    """Mean and median order value by month. The median is the middle rank
    (or the mean of the two) in one range-partitioned order of all rows, so a
    month is not held by one reducer."""
    rows = orders.select(month_of("o_orderdate").alias("month"), "o_totalprice", "o_orderkey")
    by_month = rows.groupBy("month").agg(F.avg("o_totalprice").alias("mean_check"), F.count(F.lit(1)).alias("orders"),
                                         F.count("o_totalprice").alias("_n"))
    by_month = reliable_checkpoint(by_month)  # one row per month
    first = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    by_month = by_month.withColumn("_before", F.coalesce(F.sum("_n").over(first), F.lit(0)))
    ranked = ordered_prefix_sums(rows.where("o_totalprice is not null"), [F.col("month"), F.col("o_totalprice"), F.col("o_orderkey")],
                                 {}, row_number="_rank")
    middle = ranked.join(by_month, "month")
    at = F.col("_rank") - F.col("_before")
    middle = middle.where((at >= (F.col("_n") + 1) / 2 - 0.5) & (at <= (F.col("_n") + 1) / 2 + 0.5))
    medians = middle.groupBy("month").agg(F.avg("o_totalprice").alias("median_check"))
    return by_month.join(medians, "month", "left").select("month", "mean_check", "median_check", "orders")


def payments_daily(orders: DataFrame, statuses=("F", "O", "P"), paid: str = "F") -> DataFrame:
    """Daily amount, paid amount and share of orders by status (a
    conditional aggregation per status, no pivot shuffle)."""
    st = F.col("o_orderstatus")
    return orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.sum("o_totalprice").alias("amount"),
        F.coalesce(F.sum(F.when(st == paid, F.col("o_totalprice"))), F.lit(0.0)).alias("paid_amount"),
        *[F.avg(F.when(st == s, 1.0).otherwise(0.0)).alias(f"share_{s.lower()}") for s in statuses])


# ------------------------------------------------------------------- T7 MRR
def mrr_movements(orders: DataFrame) -> DataFrame:
    """Monthly revenue per customer on a dense month grid (first active
    month .. last month of the data + 1) split into new / expansion /
    contraction / churned / reactivated amounts per month."""
    cm = orders.groupBy("o_custkey", month_of("o_orderdate").alias("month")).agg(
        F.sum("o_totalprice").alias("rev"))
    last = cm.agg(F.max("month")).first()[0]
    first = cm.groupBy("o_custkey").agg(F.min("month").alias("m0"))
    grid = first.select("o_custkey", "m0", F.explode(F.sequence(
        F.col("m0"), F.add_months(F.lit(last), 1), F.expr("interval 1 month"))).alias("month"))
    g = grid.join(cm, ["o_custkey", "month"], "left").withColumn("rev", F.coalesce("rev", F.lit(0.0)))
    w = Window.partitionBy("o_custkey").orderBy("month")
    prev = F.lag("rev").over(w)
    g = g.withColumn("prev", prev)
    cur, p = F.col("rev"), F.col("prev")
    kind = (F.when(p.isNull() & (cur > 0), "new")
            .when((p > 0) & (cur > p), "expansion")
            .when((p > 0) & (cur > 0) & (cur < p), "contraction")
            .when((p > 0) & (cur == 0), "churned")
            .when((p == 0) & (cur > 0), "reactivated"))
    g = g.withColumn("kind", kind).withColumn("delta", cur - F.coalesce(p, F.lit(0.0)))
    return g.groupBy("month").agg(
        F.sum("rev").alias("mrr"),
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("delta"))), F.lit(0.0)).alias(k)
          for k in ("new", "expansion", "contraction", "churned", "reactivated")])


# --------------------------------------------------------- T9 / T10 retention
def retention_day_n(activity: DataFrame, days=(1, 7, 14), user: str = "user_id", day: str = "day") -> DataFrame:
    """Share of users active exactly n days after their first day (over
    users whose first day + n is inside the observed range)."""
    ud = activity.select(F.col(user).alias("u"), F.col(day).alias("d")).distinct()
    hi = ud.agg(F.max("d")).first()[0]
    first = ud.groupBy("u").agg(F.min("d").alias("d0"))
    active = ud.select("u", F.col("d").alias("target"), F.lit(1).alias("_hit"))
    out = None
    for n in days:
        base = first.where(F.date_add("d0", n) <= F.lit(hi)).withColumn("target", F.date_add("d0", n))
        r = base.join(active, ["u", "target"], "left").agg(
            F.count(F.lit(1)).alias("cohort_users"), F.count("_hit").alias("retained_users"))
        r = r.select(F.lit(n).alias("n"), "cohort_users", "retained_users")
        out = r if out is None else out.unionByName(r)
    return out.withColumn("retention", safe_div(F.col("retained_users"), F.col("cohort_users")))


def cohort_retention(activity: DataFrame, user: str = "user_id", day: str = "day") -> DataFrame:
    """Weekly cohorts (Monday of the first active day) x weeks since
    cohort -> active users and share of the cohort (long format)."""
    from tillwise.functions.dates import week_monday
    uw = activity.select(F.col(user).alias("u"), week_monday(day).alias("wk")).distinct()
    first = uw.groupBy("u").agg(F.min("wk").alias("cohort"))
    j = uw.join(first, "u").withColumn("period", (F.datediff("wk", "cohort") / 7).cast("int"))
    size = first.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    act = j.groupBy("cohort", "period").agg(F.count(F.lit(1)).alias("users"))
    return act.join(size, "cohort").withColumn("retention", F.col("users") / F.col("cohort_size"))


# ------------------------------------------------------------- T11 churn set
def churn_dataset(orders: DataFrame, horizon_days: int = 90) -> DataFrame:
    """Reference date = last order date - horizon. Features from orders
    up to it; label 1 when the customer has no order in the next horizon."""
    hi = orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    ref = F.date_sub(F.lit(hi), horizon_days)
    o = orders.select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_totalprice")
    past = o.where(F.col("d") <= ref).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_spent"),
        F.datediff(ref, F.max("d")).alias("days_since_last"))
    future = o.where((F.col("d") > ref) & (F.col("d") <= F.date_add(ref, horizon_days))).select("o_custkey").distinct()
    lab = past.join(future.withColumn("_active", F.lit(1)), "o_custkey", "left")
    return lab.withColumn("churned", F.when(F.col("_active").isNull(), 1).otherwise(0)).drop("_active")


# ---------------------------------------------------------------- T13 RFM
def ntile_exact(df: DataFrame, order: list[Column], k: int, out: str) -> DataFrame:
    """``ntile(k)`` over a global order without a single-task window: the
    1-based position comes from range-partitioned running counts."""
    n = df.count()
    pos = ordered_prefix_sums(df, order, {}, row_number="_pos")
    size, extra = n // k, n % k
    r = F.col("_pos")
    big = F.lit(extra * (size + 1))
    bucket = F.when(r <= big, F.floor((r - 1) / F.lit(size + 1)) + 1).otherwise(
        F.lit(extra) + F.floor((r - big - 1) / F.lit(max(size, 1))) + 1)
    return pos.withColumn(out, bucket.cast("int")).drop("_pos")


def rfm_segments(orders: DataFrame, k: int = 5) -> DataFrame:
    """Recency (days before the last order date), frequency and monetary
    value per customer, each scored 1..k by ``ntile`` (5 = best)."""
    hi = orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    c = orders.groupBy("o_custkey").agg(
        F.datediff(F.lit(hi), F.max(F.to_date("o_orderdate"))).alias("recency"),
        F.count(F.lit(1)).alias("frequency"), F.sum("o_totalprice").alias("monetary"))
    c = ntile_exact(c, [F.col("recency").desc(), F.col("o_custkey")], k, "r_score")
    c = ntile_exact(c, [F.col("frequency").asc(), F.col("o_custkey")], k, "f_score")
    c = ntile_exact(c, [F.col("monetary").asc(), F.col("o_custkey")], k, "m_score")
    return c.withColumn("segment", F.concat_ws("", "r_score", "f_score", "m_score"))


# ---------------------------------------------------- T27 / T30 / T31 / T32
def silent_entities(events: DataFrame, key: str = "user_id", ts: str = "ts", factor: float = 3.0) -> DataFrame:
    """Entities whose silence since their last event exceeds ``factor``
    times their own mean gap between events (gaps from the range-split keyed
    sequence, mean via partial sums)."""
    from tillwise.functions.prefix import keyed_sequence
    e = events.select(F.col(key).alias("_k"), _micros(ts).alias("_t"), F.col("event_id"))
    g = keyed_sequence(e, "_k", ["_t", "event_id"], ["_t"]).withColumn("_gap", F.col("_t") - F.col("prev__t"))
    now = events.agg(F.max(_micros(ts))).first()[0]
    s = g.groupBy(F.col("_k").alias(key)).agg(F.avg("_gap").alias("mean_gap_us"), F.max("_t").alias("last_us"),
                                              F.count(F.lit(1)).alias("n_events"))
    s = s.withColumn("silence_us", F.lit(now) - F.col("last_us"))
    return s.withColumn("is_silent", F.coalesce(F.col("silence_us") > F.lit(factor) * F.col("mean_gap_us"),
                                                F.lit(False)))


def price_elasticity(df: DataFrame, key: str, price: str, qty: str) -> DataFrame:
    """Slope of log(qty) on log(price) per key (``regr_slope``)."""
    ok = df.where((F.col(price) > 0) & (F.col(qty) > 0))
    return ok.groupBy(key).agg(F.regr_slope(F.log(qty), F.log(price)).alias("elasticity"),
                               F.count(F.lit(1)).alias("n"))


def asof_price(observations: DataFrame, key: str, day: str, price: str) -> DataFrame:
    """For every key and calendar day, the latest observed price on or
    before that day (calendar rows and observations unioned, then
    ``last(ignorenulls)`` in a window partitioned by key: no range join)."""
    obs = observations.groupBy(F.col(key).alias("key"), F.col(day).alias("day")).agg(F.avg(price).alias("obs"))
    r = obs.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    cal = obs.select("key").distinct().select("key", F.explode(F.sequence(F.lit(r["lo"]), F.lit(r["hi"])))
                                              .alias("day"))
    u = cal.join(obs, ["key", "day"], "left")
    w = Window.partitionBy("key").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return u.select(F.col("key").alias(key), "day", F.last("obs", ignorenulls=True).over(w).alias("price_asof"))


def surge_ratio(events: DataFrame, ts: str = "ts", window: str = "1 hour", cap: float = 2.0) -> DataFrame:
    """Per time window demand (views + clicks) over supply (purchases),
    and a multiplier clipped to [1, cap]."""
    e = events.select(F.window(F.col(ts).cast("timestamp"), window).alias("w"), "event_type")
    g = e.groupBy("w").agg(F.count(F.when(F.col("event_type").isin("view", "click"), 1)).alias("demand"),
                           F.count(F.when(F.col("event_type") == "purchase", 1)).alias("supply"))
    ratio = F.col("demand") / F.greatest(F.col("supply"), F.lit(1))
    return g.select(F.unix_micros(F.col("w.start")).alias("window_start_us"), "demand", "supply",
                    ratio.alias("ratio"),
                    F.least(F.lit(cap), F.greatest(F.lit(1.0), ratio / 2.0)).alias("multiplier"))


# ------------------------------------------------------------ T4 promo join
def promo_coverage(facts: DataFrame, fact_day: str, promos: DataFrame, start: str, end: str,
                   measure: str) -> tuple[DataFrame, DataFrame]:
    """T4: facts falling inside promo intervals [start, end].

    Intervals are expanded to their days and both sides are first reduced to
    one row per day, so the join is an equi-join on day and never emits
    (fact, promo) pairs. Returns (per-fact active-promo count, per-promo
    measure total)."""
    days = promos.select("promo_id", F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day"))
    active = days.groupBy("day").agg(F.count(F.lit(1)).alias("n_active_promos"))
    f = facts.withColumn("day", F.to_date(fact_day))
    per_fact = f.join(active, "day", "left").withColumn(
        "n_active_promos", F.coalesce("n_active_promos", F.lit(0))).withColumn(
        "in_promo", F.col("n_active_promos") > 0)
    daily = f.groupBy("day").agg(F.sum(measure).alias("m"), F.count(F.lit(1)).alias("n"))
    per_promo = days.join(daily, "day", "left").groupBy("promo_id").agg(
        F.coalesce(F.sum("m"), F.lit(0.0)).alias(f"{measure}_in_promo"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("facts_in_promo"))
    return per_fact, per_promo
