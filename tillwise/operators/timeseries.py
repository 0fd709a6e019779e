"""Panel time series: calendars, sales grids, lags, rolling and forward
windows (C5-C8, D1, D2, D4, D8, E1-E6, F6, L7, E2).

Windows are always partitioned by the entity key (sku / product), so each task
holds one key's history; the only global quantities (min/max day, cut-off
day) are fetched as bounded scalar rows. Dense calendars are generated with
``sequence`` + ``explode`` per key, not by joining two tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.dates import day_string, week_key
from tillwise.session import reliable_checkpoint

# Order statuses that do not count as sales
EXCLUDED_STATUSES = ("Return", "Lost", "Canceled")

# Default rolling-feature and target configuration of the
# demand model, as (column, window, aggregation, quantile per cent)
DEFAULT_FEATURES = {
    "qty_7d_avg": ("qty", 7, "avg", None),
    "qty_7d_q10": ("qty", 7, "quantile", 10),
    "qty_7d_q50": ("qty", 7, "quantile", 50),
    "qty_7d_q90": ("qty", 7, "quantile", 90),
    "qty_14d_avg": ("qty", 14, "avg", None),
    "qty_14d_q10": ("qty", 14, "quantile", 10),
    "qty_14d_q50": ("qty", 14, "quantile", 50),
    "qty_14d_q90": ("qty", 14, "quantile", 90),
    "qty_21d_avg": ("qty", 21, "avg", None),
    "qty_21d_q10": ("qty", 21, "quantile", 10),
    "qty_21d_q50": ("qty", 21, "quantile", 50),
    "qty_21d_q90": ("qty", 21, "quantile", 90),
}
DEFAULT_TARGETS = {"next_7d": ("qty", 7), "next_14d": ("qty", 14), "next_21d": ("qty", 21)}


# ------------------------------------------------------------ weekly (BOOST)
def weekly_product_sales(df: DataFrame, product: str = "product_name", dt: str = "dt",
                         price: str = "price") -> DataFrame:
    """Per product and Monday: max price and number of sales rows."""
    return df.groupBy(F.col(product).alias("product_name"), week_key(dt, "monday").alias("monday")).agg(
        F.max(price).alias("max_price"), F.count(F.lit(1)).alias("y"))


def week_lags(df: DataFrame, key: str = "product_name", order: str = "monday", value: str = "y",
              lags: int = 6, prefix: str = "y_lag_") -> DataFrame:
    """``lag(y, k, 0)`` over existing rows (missing weeks are not filled)."""
    w = Window.partitionBy(key).orderBy(order)
    out = df
    for k in range(1, lags + 1):
        out = out.withColumn(f"{prefix}{k}", F.lag(value, k, 0).over(w))
    return out


def lag_stats(df: DataFrame, prefix: str, out_prefix: str, spans=(3, 6)) -> DataFrame:
    """Average / max / min of the first k lag columns (divisor as double)."""
    out = df
    for k in spans:
        cols = [F.col(f"{prefix}{i}") for i in range(1, k + 1)]
        total = cols[0]
        for c in cols[1:]:
            total = total + c
        out = (out.withColumn(f"{out_prefix}avg_{k}", total / F.lit(float(k)))
               .withColumn(f"{out_prefix}max_{k}", F.greatest(*cols))
               .withColumn(f"{out_prefix}min_{k}", F.least(*cols)))
    return out


def global_week_sums(lagged: DataFrame, lags: int = 6) -> DataFrame:
    """Sums of the lag columns over all products, per Monday."""
    return lagged.groupBy("monday").agg(*[F.sum(f"y_lag_{k}").alias(f"y_all_lag_{k}")
                                          for k in range(1, lags + 1)])


def join_left_week(product_features: DataFrame, global_features: DataFrame) -> DataFrame:
    """C4: product features left join global features on Monday. The global
    side has one row per week; AQE broadcasts it after measuring it."""
    return product_features.join(global_features, "monday", "left")


# -------------------------------------------------------- daily panel (DEMAND)
def daily_qty(orders: DataFrame, by=("sku_id",)) -> DataFrame:
    """Quantity summed per day and key."""
    return orders.groupBy(F.to_date("ts").alias("day"), *by).agg(F.sum("qty").alias("qty"))


def day_bounds(df: DataFrame, day: str = "day") -> tuple:
    """(min day, max day) as one bounded scalar row."""
    r = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    return r["lo"], r["hi"]


def order_days(orders: DataFrame) -> tuple:
    """(first day, last day) of the orders, which are those of their dense panel too."""
    return day_bounds(orders.select(F.to_date("ts").alias("day")))


def dense_calendar(keys: DataFrame, lo, hi, day: str = "day") -> DataFrame:
    """Every day in [lo, hi] for every key row (a generator per key)."""
    seq = F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"), F.expr("interval 1 day"))
    return keys.select("*", F.explode(seq).alias(day))


def _followed_by_gaps(sales: DataFrame, ids: DataFrame, lo, hi) -> DataFrame:
    """Rows of ``sales`` (day renamed ``_sold``) with ``_days``: their own day and the days without
    a sale up to the next row of their sku_id, in [lo, hi]. The first row of each of ``ids`` is no sale
    (``_sale`` false) but the eve of the calendar. So the days of a key are made where
    its sales are, and not shuffled to meet them. Sales without a day or key meet none."""
    eve = ids.select(*[F.date_sub(F.lit(lo).cast("date"), 1).alias("day") if f.name == "day" else F.col("sku_id") if f.name == "sku_id"
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in sales.schema.fields], F.lit(False).alias("_sale"))
    rows = sales.where(F.col("day").isNotNull() & F.col("sku_id").isNotNull()).withColumn("_sale", F.lit(True)).unionByName(eve)
    rows = rows.repartition(int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sku_id")
    upto = F.date_sub(F.coalesce(F.lead("day").over(Window.partitionBy("sku_id").orderBy("day")),
                                 F.date_add(F.lit(hi).cast("date"), 1)), 1)
    since, none = F.date_add("day", 1), F.array().cast("array<date>")
    gap = F.when(since <= upto, F.sequence(since, upto, F.expr("interval 1 day"))).otherwise(none)
    days = F.concat(F.when(F.col("_sale"), F.array("day")).otherwise(none), gap)
    return rows.withColumn("_days", days).withColumnRenamed("day", "_sold")


def extract_sales(orders: DataFrame, bounds: tuple | None = None, since=None) -> DataFrame:
    """Daily (day, sku_id, sku, price) sums on the dense calendar, from the first to the
    last day of the orders (``bounds``, where the caller knows them). Days before ``since``
    are not made.

    Missing days get qty 0; sku / price are back-filled from the order
    dimension by sku_id (one row per distinct (sku, price) of that sku_id, as
    the reference's merge does). No status filter.
    """
    sales = orders.groupBy(F.to_date("ts").alias("day"), "sku_id", "sku", "price").agg(
        F.sum("qty").alias("qty"))
    lo, hi = bounds or order_days(orders)
    if since is not None and lo is not None:
        lo, sales = max(lo, since), sales.where(F.col("day") >= F.lit(since))
    rows = _followed_by_gaps(sales, orders.select("sku_id").distinct(), lo, hi)
    dims = orders.select("sku_id", F.col("sku").alias("sku_d"), F.col("price").alias("price_d")).distinct()
    g = rows.join(dims, "sku_id", "left").select("*", F.explode("_days").alias("day"))
    own = F.col("_sale") & (F.col("day") == F.col("_sold"))
    return g.select("day", "sku_id", F.coalesce(F.when(own, F.col("sku")), "sku_d").alias("sku"),
                    F.coalesce(F.when(own, F.col("price")), "price_d").alias("price"),
                    F.coalesce(F.when(own, F.col("qty")), F.lit(0)).cast("long").alias("qty"))


def valid_orders(orders: DataFrame, status: DataFrame) -> DataFrame:
    """Orders with at least one status row outside the excluded set
    (left semi join; the status side is filtered before the shuffle)."""
    ok = status.where(~F.col("status").isin(*EXCLUDED_STATUSES)).select("order_id")
    return orders.join(ok, "order_id", "left_semi")


def demand_grid(orders: DataFrame, status: DataFrame) -> DataFrame:
    """Observed days x distinct (sku_id, sku, price), status-filtered daily
    sums left-joined, qty NULL -> 0, day as 'YYYY-MM-DD', ordered.

    The day x sku product is built as a per-key calendar (generator) reduced
    to the observed days by a semi join, so no cartesian join is planned.
    """
    every = orders.select(F.to_date("ts").alias("day"))
    days = every.distinct()
    lo, hi = day_bounds(every)
    skus = orders.select("sku_id", "sku", "price").distinct()
    sales = daily_qty(valid_orders(orders, status)).withColumnRenamed("qty", "total_qty")
    rows = _followed_by_gaps(sales, skus.select("sku_id").distinct(), lo, hi)
    named = skus.withColumnRenamed("sku_id", "_id")
    g = rows.join(named, F.col("sku_id").eqNullSafe(F.col("_id"))).select("*", F.explode("_days").alias("day"))
    own = F.col("_sale") & (F.col("day") == F.col("_sold"))
    return g.join(days, "day", "left_semi").select(
        day_string("day").alias("day"), "sku_id", "sku", "price",
        F.coalesce(F.when(own, F.col("total_qty")), F.lit(0)).alias("qty")).orderBy("sku_id", "day")


def _strict(df: DataFrame, order: str) -> list[str]:
    """The window order; with several prices a day, rows of a day go by price."""
    return [order, "price"] if "price" in df.columns and order != "price" else [order]


def _window_quantiles(values: np.ndarray, counted: np.ndarray, start: np.ndarray, n: int, quantiles: list[float],
                      full: bool, first: int, rows: int = 8192) -> list[pa.Array]:
    """Quantiles of the last ``n`` rows from ``start`` on, for the rows from ``first`` on. Windows are sorted a
    block of rows at a time; what does not count is NaN, which sorts last as Spark's NaN does."""
    padded = np.concatenate([np.full(n - 1, np.nan), np.where(counted, values, np.nan)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, n)
    seen = np.concatenate([[0], np.cumsum(counted)])
    found: list[list[np.ndarray]] = [[] for _ in quantiles]
    void = []
    for lo in range(first, len(values), rows):
        at = np.arange(lo, min(lo + rows, len(values)))
        since = np.maximum(start[at], at - n + 1)
        ordered = np.sort(windows[lo:lo + rows], axis=1)
        cut = since - (at - n + 1)  # rows of the key before that the window would reach into
        short = np.flatnonzero(cut)
        ordered[short] = np.sort(np.where(np.arange(n) < cut[short, None], np.nan, windows[at[short]]), axis=1)
        count = seen[at + 1] - seen[since]
        void.append(count != n if full else count == 0)
        line = np.arange(len(at))
        for q, out in zip(quantiles, found):
            pos = np.maximum(count - 1, 0) * q
            below, above = np.floor(pos).astype(int), np.ceil(pos).astype(int)
            v = ordered[line, below]
            with np.errstate(invalid="ignore"):
                between = v + (pos - below) * (ordered[line, above] - v)
            out.append(np.where(below == above, v, between))
    return [pa.array(np.concatenate(out), mask=np.concatenate(void)) for out in found]


def _sliding_quantiles(df: DataFrame, features: dict[str, tuple[str, int, float]], key: str, by: list[str],
                       min_periods: str) -> DataFrame:
    """Quantiles {name: (column, rows, q)} of sliding windows. Rows stream in the order of key and ``by``;
    a task holds a batch and the rows of one window before it, however long a key's history is."""
    wanted: dict[tuple[str, int], list[tuple[str, float]]] = {}
    for name, (col, n, q) in features.items():
        wanted.setdefault((col, n), []).append((name, q))
    kept, reach = [c for c in df.columns if c not in features], max(n for _, n in wanted) - 1
    columns = {col: f"_value_{i}" for i, col in enumerate(dict.fromkeys(col for col, _ in wanted))}

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch]).select([key, *columns.values()])
            both = pa.concat_tables([before, now]).combine_chunks() if before is not None else now
            first, size = both.num_rows - batch.num_rows, both.num_rows
            keys = both.column(key).combine_chunks()
            a, b = keys.slice(1), keys.slice(0, size - 1)
            change = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | (
                a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
            start = np.maximum.accumulate(np.where(np.concatenate([[True], change]), np.arange(size), 0))
            found = {}
            for (col, n), asked in wanted.items():
                v = both.column(columns[col])
                counted = v.is_valid().to_numpy()
                found |= zip([name for name, _ in asked],
                             _window_quantiles(v.to_numpy(), counted, start, n, [q for _, q in asked],
                                               min_periods == "window", first))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[found[f] for f in features]],
                                             names=[*kept, *features])
            before = both.slice(max(size - reach, 0))

    shape = T.StructType([*[f for f in df.schema.fields if f.name in kept], *[T.StructField(f, T.DoubleType()) for f in features]])
    rows = df.select("*", *[F.col(col).cast("double").alias(v) for col, v in columns.items()])
    # the window gathers the rows of a key, without a shuffle where they already lie together
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy(key).orderBy(*by)))
    return rows.sortWithinPartitions(key, *by).mapInArrow(slide, shape)


def add_rolling_features(df: DataFrame, features: dict | None = None, key: str = "sku_id",
                         order: str = "day", min_periods: str = "one") -> DataFrame:
    """Rolling mean / linear-interpolated quantile over the last N rows
    (current row included). ``min_periods='one'`` (features.py) or
    ``'window'`` (feature_engineering.py: NULL until N rows exist)."""
    features = features or DEFAULT_FEATURES
    by = _strict(df, order)
    quantiles = {k: (c, n, q / 100.0) for k, (c, n, a, q) in features.items() if a == "quantile"}
    out = df
    # integral columns without NULLs get running totals for the means
    integral = {f.name for f in df.schema.fields if not f.nullable and
                isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))}
    for col in sorted({c for c, n, a, q in features.values() if a == "avg"} & integral):
        out = out.withColumn(f"_cum_{col}", F.sum(F.col(col)).over(
            Window.partitionBy(key).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)))
    for name, (col, n, agg, q) in features.items():
        w = Window.partitionBy(key).orderBy(*by).rowsBetween(-(n - 1), 0)
        if agg == "avg" and col in integral:
            # exact integer trailing sum from the running total; rows seen so
            # far from the row number (the dense panel has no NULLs)
            base = Window.partitionBy(key).orderBy(*by)
            cum = F.col(f"_cum_{col}")
            total = cum - F.coalesce(F.lag(cum, n).over(base), F.lit(0))
            cnt = F.least(F.row_number().over(base), F.lit(n))
            v = total.cast("double") / cnt
            if min_periods == "window":
                v = F.when(cnt == n, v)
        elif agg == "avg":
            v = F.avg(F.col(col).cast("double")).over(w)
            if min_periods == "window":
                v = F.when(F.count(F.col(col)).over(w) == n, v)
        elif agg == "quantile":
            continue
        else:
            raise ValueError(f"Unknown aggregation function: {agg}")
        out = out.withColumn(name, v)
    # last, as the means need the rows of a key together as well and what leaves Python counts as not gathered
    if quantiles:
        out = _sliding_quantiles(out.drop(*[c for c in out.columns if c.startswith("_cum_")]), quantiles, key, by, min_periods)
    return out.select(*[c for c in df.columns if c not in features], *features)


def add_targets(df: DataFrame, targets: dict | None = None, key: str = "sku_id", order: str = "day",
                variant: str = "next") -> DataFrame:
    """E5 (``next``): sum of the next N rows, NULL when fewer remain.
    E6 (``as_coded``): ``shift(-1).rolling(N).sum()`` = rows t-N+2 .. t+1,
    NULL unless rows t-N+1 .. t+1 all exist."""
    targets = targets or DEFAULT_TARGETS
    base = Window.partitionBy(key).orderBy(*_strict(df, order))
    out = df
    integral = {f.name for f in df.schema.fields if not f.nullable and
                isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))}
    cums = {}
    for name, (col, n) in targets.items():
        if col in integral and col not in cums:
            # exact integer running total; window sums become differences of
            # two offsets (O(1) per row instead of re-summing each frame)
            cums[col] = f"_cum_{col}"
            out = out.withColumn(cums[col], F.sum(F.col(col)).over(base.rowsBetween(Window.unboundedPreceding, 0)))
    for name, (col, n) in targets.items():
        c = F.col(col)
        if col in cums:
            cum = F.col(cums[col])
            if variant == "next":
                v = F.lead(cum, n).over(base) - cum
            elif variant == "as_coded":
                v = F.lead(cum, 1).over(base) - F.lag(cum, n - 1).over(base)
            else:
                raise ValueError("variant must be 'next' or 'as_coded'")
        elif variant == "next":
            w = base.rowsBetween(1, n)
            v = F.when(F.count(c).over(w) == n, F.sum(c).over(w))
        elif variant == "as_coded":
            guard = base.rowsBetween(-(n - 1), 1)
            w = base.rowsBetween(-(n - 2), 1)
            v = F.when(F.count(c).over(guard) == n + 1, F.sum(c).over(w))
        else:
            raise ValueError("variant must be 'next' or 'as_coded'")
        out = out.withColumn(name, v.cast("double"))
    return out.drop(*cums.values())


def train_test_split(df: DataFrame, test_days: int = 30, day: str = "day", bounds: tuple | None = None) -> DataFrame:
    """Role 'test' for the last ``test_days`` days (>= max - (n-1)). The first and last day of
    ``df`` are looked for in it, which makes all its rows, unless given as ``bounds``."""
    _, hi = bounds or day_bounds(df, day)
    cutoff = F.date_sub(F.lit(hi).cast("date"), test_days - 1)
    return df.withColumn("role", F.when(F.col(day) >= cutoff, F.lit("test")).otherwise(F.lit("train")))


def last_day_rows(df: DataFrame, day: str = "day") -> DataFrame:
    """rows at the global maximum day (scalar max, then a pushed filter)."""
    _, hi = day_bounds(df, day)
    return df.where(F.col(day) == F.lit(hi).cast("date"))


def week_missed_profits(df: DataFrame, sales: str = "sales", forecast: str = "forecast",
                        day: str = "day", price: str = "price") -> DataFrame:
    """Weekly (Sunday-end label) revenue and missed profit
    max(forecast - sales, 0) * price, including empty weeks as 0."""
    d = df.select(F.to_date(day).alias("day"),
                  (F.greatest(F.col(forecast) - F.col(sales), F.lit(0)) * F.col(price)).alias("missed_profits"),
                  (F.col(sales) * F.col(price)).alias("revenue"))
    wk = d.groupBy(week_key("day", "sunday_end").alias("day")).agg(
        F.sum("revenue").alias("revenue"), F.sum("missed_profits").alias("missed_profits"))
    lo, hi = day_bounds(wk)
    spark = df.sparkSession
    weeks = spark.range(1).select(F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"),
                                                       F.expr("interval 7 days"))).alias("day"))
    j = weeks.join(wk, "day", "left")
    return j.select("day", F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
                    F.coalesce("missed_profits", F.lit(0.0)).alias("missed_profits"))


# ------------------------------------------------------------ gaps & islands
def gaps_islands(df: DataFrame, col: str = "log_id", ranges: int | None = None) -> DataFrame:
    """``prev = lag(id)``, ``flg = 0`` when the step is 1 else 1,
    ``grp = sum(flg) over (order by id)`` (RANGE frame: equal ids share it).

    Global order without a single-task window: ids are range-partitioned and
    checkpointed; the last id and the flag total of every earlier range are
    carried in by a broadcast of one row per range (a bounded table).
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.select(col).repartitionByRange(n, col).withColumn("_rid", F.spark_partition_id())
    r = reliable_checkpoint(r)
    ordered = Window.orderBy("_rid")
    stats = r.groupBy("_rid").agg(F.max(col).alias("_last"))
    stats = stats.select("_rid", F.lag("_last").over(ordered).alias("_carry"))
    inside = Window.partitionBy("_rid").orderBy(col)
    x = r.join(F.broadcast(stats), "_rid")
    x = x.withColumn("prev_" + col, F.coalesce(F.lag(col).over(inside), F.col("_carry")))
    prev = F.col("prev_" + col)
    x = x.withColumn("_flg", F.when(prev.isNotNull() & (F.col(col) - prev == 1), 0).otherwise(1))
    x = reliable_checkpoint(x)
    tot = x.groupBy("_rid").agg(F.sum("_flg").alias("_f"))
    tot = tot.select("_rid", F.coalesce(F.sum("_f").over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
                                        F.lit(0)).alias("_off"))
    running = Window.partitionBy("_rid").orderBy(col).rangeBetween(Window.unboundedPreceding, 0)
    x = x.join(F.broadcast(tot), "_rid").withColumn("grp", F.col("_off") + F.sum("_flg").over(running))
    return x.select(col, "prev_" + col, "grp")
