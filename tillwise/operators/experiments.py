"""Resampling and experiment statistics (M23 and the experiment titles).

Bootstrap draws are ``md5``-derived uniforms keyed by (seed, replicate,
draw): deterministic, independent of partitioning and task retries, and
reproducible in SQL. Drawing n of n rows ``n_boot`` times makes n * n_boot
draws, generated and joined with the numbered rows by Spark; aggregate to
periods first where that is many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.numeric import md5_uniform  # noqa: F401 (re-exported)
from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.session import reliable_checkpoint


def bootstrap_mean_ci(df: DataFrame, value: str, base: str | None = None, n_boot: int = 1000,
                      confidence: float = 0.95, seed: int = 42, order: str = "day") -> DataFrame:
    """Mean of ``value`` (and ``mean(value)/mean(base)``) with
    percentile-bootstrap confidence intervals, one output row."""
    n = df.count()
    if n == 0:
        raise ValueError("empty input")
    spark = df.sparkSession
    idx = ordered_prefix_sums(df.select(order, value, *([base] if base else [])), [F.col(order)], {}, row_number="_i")
    idx = idx.select((F.col("_i") - 1).alias("_i"), value, *([base] if base else []))
    draws = spark.range(n_boot * n).select(F.floor(F.col("id") / n).alias("b"), (F.col("id") % n).alias("j"))
    draws = draws.withColumn("_i", F.floor(md5_uniform(seed, F.col("b"), F.col("j")) * F.lit(n)))
    sample = draws.join(idx, "_i")
    aggs = [F.avg(value).alias("m")] + ([F.avg(base).alias("r")] if base else [])
    per = sample.groupBy("b").agg(*aggs)
    if base:
        per = per.withColumn("rel", F.col("m") / F.col("r"))
    lo, hi = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    stats = [F.percentile("m", [lo, hi]).alias("ci")]
    if base:
        stats.append(F.percentile("rel", [lo, hi]).alias("rci"))
    ci = per.agg(*stats)
    point = df.agg(F.avg(value).alias("mean"), *([F.avg(base).alias("base_mean")] if base else []))
    cols = [F.col("mean").alias(f"avg_{value}"), F.col("ci")[0].alias("abs_ci_lower"),
            F.col("ci")[1].alias("abs_ci_upper")]
    if base:
        cols += [(F.col("mean") / F.col("base_mean")).alias(f"relative_{value}"),
                 F.col("rci")[0].alias("rel_ci_lower"), F.col("rci")[1].alias("rel_ci_upper")]
    # two one-row results merged by union + aggregate
    pcols = ["mean"] + (["base_mean"] if base else [])
    ccols = ["ci"] + (["rci"] if base else [])
    both = point.select(*pcols, *[F.lit(None).cast(ci.schema[c].dataType).alias(c) for c in ccols]).unionByName(
        ci.select(*[F.lit(None).cast("double").alias(c) for c in pcols], *ccols))
    merged = both.agg(*[F.max(c).alias(c) for c in pcols], *[F.first(c, ignorenulls=True).alias(c) for c in ccols])
    return merged.select(*cols)


def quantile_test(df: DataFrame, value: str, arm: str, key: str, quantiles: list[float], a: str = "A", b: str = "B",
                  n_boot: int = 1000, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """Difference of quantiles between two arms with a bootstrap interval,
    one row per quantile, without drawing samples: the p-quantile of a resample
    of n sorted rows is the row whose rank is Binomial(n + 1, p), here by its
    normal approximation with md5 uniforms (Box-Muller). So a replicate needs
    one rank per arm and quantile, looked up in one range-partitioned order of
    the rows: one sort whatever the number of replicates."""
    rows = df.where(F.col(arm).isin(a, b) & F.col(value).isNotNull()).select(F.col(arm).alias("arm"), F.col(value).cast("double").alias("v"), F.col(key).alias("k"))
    sizes = {r["arm"]: r["n"] for r in rows.groupBy("arm").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {a, b}:
        raise ValueError("both arms need rows")
    spark = df.sparkSession
    ranked = ordered_prefix_sums(rows, [F.col("arm"), F.col("v"), F.col("k")], {}, row_number="rank")
    first, second = sorted((a, b))
    start = F.when(F.col("arm") == second, F.lit(sizes[first])).otherwise(F.lit(0))
    ranked = reliable_checkpoint(ranked.select("arm", "v", (F.col("rank") - start).alias("rank")))
    plan = spark.createDataFrame([(x, float(q), int(sizes[x])) for x in (a, b) for q in quantiles], "arm string, q double, n long")
    u1 = F.greatest(md5_uniform(seed, F.col("arm"), F.col("q").cast("string"), F.col("b"), F.lit(1)), F.lit(1e-12))
    u2 = md5_uniform(seed, F.col("arm"), F.col("q").cast("string"), F.col("b"), F.lit(2))
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
    mean, spread = (F.col("n") + 1) * F.col("q"), F.sqrt((F.col("n") + 1) * F.col("q") * (1 - F.col("q")))

    def at(rank):
        return F.least(F.greatest(F.round(rank).cast("long"), F.lit(1)), F.col("n"))

    # replicate -1 is the sample itself
    draws = plan.select("*", F.explode(F.sequence(F.lit(-1), F.lit(n_boot - 1))).alias("b"))
    draws = draws.select("arm", "q", "b", F.when(F.col("b") < 0, at(mean)).otherwise(at(mean + spread * z)).alias("rank"))
    per = draws.join(ranked, ["arm", "rank"]).groupBy("q", "b").agg(
        F.max(F.when(F.col("arm") == a, F.col("v"))).alias("va"), F.max(F.when(F.col("arm") == b, F.col("v"))).alias("vb"))
    lo, hi = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    boot, diff = F.col("b") >= 0, F.col("vb") - F.col("va")
    out = per.groupBy("q").agg(F.max(F.when(~boot, F.col("va"))).alias("value_a"), F.max(F.when(~boot, F.col("vb"))).alias("value_b"),
                               F.percentile(F.when(boot, diff), [lo, hi]).alias("ci"))
    return out.select(F.col("q").alias("quantile"), "value_a", "value_b", (F.col("value_b") - F.col("value_a")).alias("difference"),
                      F.col("ci")[0].alias("ci_lower"), F.col("ci")[1].alias("ci_upper"))


# ------------------------------------------------------------- experiments
Z_975 = 1.959963984540054
Z_80 = 0.8416212335729143


def assign_arm(key, seed: str, arms: list[str]):
    """Deterministic arm assignment from an md5 uniform of the key."""
    u = md5_uniform(seed, key)
    idx = F.least(F.floor(u * len(arms)).cast("int"), F.lit(len(arms) - 1))
    return F.element_at(F.array(*[F.lit(a) for a in arms]), idx + 1)


def welch_ttest(df: DataFrame, value: str, arm: str, by: list[str], a: str = "A", b: str = "B") -> DataFrame:
    """Welch t statistic and degrees of freedom per metric group from
    one pass of conditional moments."""
    x = F.col(value).cast("double")
    isa, isb = F.col(arm) == a, F.col(arm) == b
    g = df.groupBy(*by).agg(
        F.count(F.when(isa, x)).alias("n_a"), F.count(F.when(isb, x)).alias("n_b"),
        F.avg(F.when(isa, x)).alias("mean_a"), F.avg(F.when(isb, x)).alias("mean_b"),
        F.var_samp(F.when(isa, x)).alias("var_a"), F.var_samp(F.when(isb, x)).alias("var_b"))
    se2 = F.col("var_a") / F.col("n_a") + F.col("var_b") / F.col("n_b")
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(se2)
    dof = se2 * se2 / ((F.col("var_a") / F.col("n_a")) ** 2 / (F.col("n_a") - 1)
                       + (F.col("var_b") / F.col("n_b")) ** 2 / (F.col("n_b") - 1))
    return g.withColumn("t_stat", t).withColumn("dof", dof)


def sample_size(df: DataFrame, value: str, by: list[str], mde_rel: float = 0.05) -> DataFrame:
    """Users per arm to detect a relative change ``mde_rel`` of the mean
    at alpha 0.05 (two-sided) and power 0.8, from historical variance."""
    x = F.col(value).cast("double")
    g = df.groupBy(*by).agg(F.avg(x).alias("mean"), F.var_samp(x).alias("variance"), F.count(x).alias("n"))
    delta = F.lit(mde_rel) * F.col("mean")
    need = F.ceil(F.lit(2 * (Z_975 + Z_80) ** 2) * F.col("variance") / (delta * delta))
    return g.withColumn("n_per_arm", need)


def uplift_by_segment(df: DataFrame, outcome: str, treated: str, segment: str) -> DataFrame:
    """Outcome rate in treatment minus control, per segment."""
    y = F.col(outcome).cast("double")
    t = F.col(treated)
    g = df.groupBy(segment).agg(F.count(F.when(t, 1)).alias("n_treat"), F.count(F.when(~t, 1)).alias("n_ctrl"),
                                F.avg(F.when(t, y)).alias("rate_treat"), F.avg(F.when(~t, y)).alias("rate_ctrl"))
    return g.withColumn("uplift", F.col("rate_treat") - F.col("rate_ctrl"))


def diff_in_diff(df: DataFrame, value: str, treated: str, post: str) -> DataFrame:
    """(treated post - treated pre) - (control post - control pre)."""
    x = F.col(value).cast("double")
    tr, po = F.col(treated), F.col(post)
    g = df.agg(F.avg(F.when(tr & po, x)).alias("treated_post"), F.avg(F.when(tr & ~po, x)).alias("treated_pre"),
               F.avg(F.when(~tr & po, x)).alias("control_post"), F.avg(F.when(~tr & ~po, x)).alias("control_pre"))
    return g.withColumn("did", (F.col("treated_post") - F.col("treated_pre"))
                        - (F.col("control_post") - F.col("control_pre")))


def psi_drift(df: DataFrame, value: str, is_current: str, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index and binned KS between a base and a
    current period, on equal-width bins of the base range (two scalars)."""
    x = F.col(value).cast("double")
    r = df.where(~F.col(is_current)).agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = float(r["lo"]), float(r["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.greatest(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    g = df.groupBy(b.alias("bin")).agg(F.count(F.when(~F.col(is_current), 1)).alias("n_base"),
                                       F.count(F.when(F.col(is_current), 1)).alias("n_cur"))
    tot = g.agg(F.sum("n_base").alias("a"), F.sum("n_cur").alias("c")).first()
    sb = F.col("n_base") / F.lit(float(tot["a"] or 1))
    sc = F.col("n_cur") / F.lit(float(tot["c"] or 1))
    g = g.select("bin", sb.alias("base_share"), sc.alias("cur_share"))
    g = g.withColumn("psi_term", (F.col("cur_share") - F.col("base_share"))
                     * F.log(F.greatest(F.col("cur_share"), F.lit(eps)) / F.greatest(F.col("base_share"), F.lit(eps))))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # <= bins rows
    g = g.withColumn("cdf_gap", F.abs(F.sum("cur_share").over(w) - F.sum("base_share").over(w)))
    all_bins = Window.partitionBy(F.lit(0))
    return g.withColumn("psi", F.sum("psi_term").over(all_bins)).withColumn("ks", F.max("cdf_gap").over(all_bins))
