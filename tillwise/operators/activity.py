"""User activity: daily and rolling distinct users.

Distinct counts inside a sliding window are not supported by Spark windows,
and a self-join over 7 days would multiply the rows. The rolling count uses
the delta method instead: per (user, day) a +1 at the day and a -1 where the
user's 7-day coverage ends (the earlier of day+N and the next active day).
Deltas are summed per day (map-side partial sums), joined onto the calendar
and accumulated. The only un-partitioned window runs over one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def user_days(df: DataFrame, user: str = "user_id", day: str = "day") -> DataFrame:
    """Pre-deduplicate to one row per (day, user)."""
    return df.select(F.col(day).alias("day"), F.col(user).alias("user_id")).dropDuplicates(["day", "user_id"])


def dau(df: DataFrame, user: str = "user_id", day: str = "day") -> DataFrame:
    """Distinct users per day."""
    return user_days(df, user, day).groupBy("day").agg(F.count(F.lit(1)).alias("dau"))


def calendar(df: DataFrame, day: str = "day") -> DataFrame:
    """Every day from the first to the last active day (bounds fetched as one
    scalar row, days generated by ``sequence``)."""
    r = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    spark = df.sparkSession
    return spark.range(1).select(F.explode(F.sequence(F.lit(r["lo"]).cast("date"), F.lit(r["hi"]).cast("date"),
                                                      F.expr("interval 1 day"))).alias("day"))


def rolling_active_users(df: DataFrame, user: str = "user_id", day: str = "day", window: int = 7) -> DataFrame:
    """Day, dau, wau (distinct users in the ``window`` days ending at the
    day) and ``sticky_factor = dau / wau`` (0 when wau = 0), on every
    calendar day between the first and last activity."""
    ud = user_days(df, user, day)
    nxt = F.lead("day").over(Window.partitionBy("user_id").orderBy("day"))
    ends = ud.withColumn("_end", F.least(F.date_add("day", window), F.coalesce(nxt, F.date_add("day", window))))
    plus = ends.groupBy("day").agg(F.count(F.lit(1)).alias("_plus"))
    minus = ends.groupBy(F.col("_end").alias("day")).agg(F.count(F.lit(1)).alias("_minus"))
    cal = calendar(ud)
    d = cal.join(plus, "day", "left").join(minus, "day", "left")
    d = d.select("day", F.coalesce("_plus", F.lit(0)).alias("dau"),
                 (F.coalesce("_plus", F.lit(0)) - F.coalesce("_minus", F.lit(0))).alias("_delta"))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("wau", F.sum("_delta").over(running))
    sticky = F.when(F.col("wau") > 0, F.col("dau") / F.col("wau")).otherwise(F.lit(0.0))
    return d.select("day", "dau", "wau", sticky.alias("sticky_factor"))


def describe(df: DataFrame, col: str, percentiles=(0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Count, mean, sample std, min, exact percentiles, max."""
    pct = F.percentile(F.col(col), list(percentiles))
    g = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
               F.min(col).alias("min"), pct.alias("_p"), F.max(col).alias("max"))
    names = [f"p{int(round(p * 100))}" for p in percentiles]
    return g.select("count", "mean", "std", "min", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)], "max")


def approx_rolling_active_users(df: DataFrame, user: str = "user_id", day: str = "day",
                                window: int = 7, lg_k: int = 12) -> DataFrame:
    """HLL sketch per day, union of the last ``window`` daily sketches.
    The per-day sketches are a few KB each, so the window over days is small."""
    ud = df.select(F.col(day).alias("day"), F.col(user).alias("user_id"))
    daily = ud.groupBy("day").agg(F.hll_sketch_agg("user_id", lg_k).alias("sk"))
    cal = calendar(ud).join(daily, "day", "left")
    w = Window.orderBy("day").rowsBetween(-(window - 1), 0)
    rolled = cal.withColumn("wsk", F.hll_union_agg("sk", True).over(w))
    return rolled.select("day", F.coalesce(F.hll_sketch_estimate("sk"), F.lit(0)).alias("dau_approx"),
                         F.coalesce(F.hll_sketch_estimate("wsk"), F.lit(0)).alias("wau_approx"))
