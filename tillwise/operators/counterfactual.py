"""Synthetic control (T37): what a treated unit would have done without its
treatment, as the mix of other units that tracked it best before."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import reliable_checkpoint


def nearest_mix(h: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """Weights w >= 0 of sum 1 with the least w'hw, for a positive semidefinite h
    (the point of a convex hull nearest to the origin, by Wolfe's active sets)."""
    n = len(h)
    scale = float(np.max(np.abs(np.diag(h)))) or 1.0
    h = h / scale
    on, w = [int(np.argmin(np.diag(h)))], np.array([1.0])
    for _ in range(50 * n):
        slope = h[:, on] @ w
        here = float(w @ slope[on])
        new = int(np.argmin(slope))
        if slope[new] >= here - tol or new in on:
            break
        on, w = [*on, new], np.append(w, 0.0)
        while True:
            k = len(on)
            system = np.ones((k + 1, k + 1))
            system[:k, :k], system[k, k] = h[np.ix_(on, on)], 0.0
            best = np.linalg.lstsq(system, np.append(np.zeros(k), 1.0), rcond=None)[0][:k]
            if (best > tol).all():
                w = best
                break
            out = best <= tol
            step = min(1.0, float(np.min(w[out] / np.maximum(w[out] - best[out], 1e-300))))
            w = w + step * (best - w)
            keep = w > tol
            if keep.all():  # rounding left nothing at zero: drop the smallest
                keep[int(np.argmin(w))] = False
            on, w = [u for u, kept in zip(on, keep) if kept], w[keep] / w[keep].sum()
    out = np.zeros(n)
    out[on] = w / w.sum()
    return out


def _gram(panel: DataFrame, units: list) -> np.ndarray:
    """Inner products of the units' series: each task adds up its periods, and the
    sums of units x units numbers are added by Spark."""
    n, at = len(units), {u: i for i, u in enumerate(units)}
    per_period = panel.groupBy("period").agg(F.collect_list(F.struct("unit", "value")).alias("row"))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n, n))
        for b in batches:
            x = np.zeros((len(b), n))
            for k, row in enumerate(b["row"]):
                for r in row:
                    x[k, at[r["unit"]]] = r["value"]
            total += x.T @ x
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": i.astype("i4"), "j": j.astype("i4"), "v": total[i, j]})

    sums = per_period.select("row").mapInPandas(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = np.zeros((n, n))
    for r in sums.collect():
        gram[r["i"], r["j"]] = r["v"]
    return gram


def synthetic_control(df: DataFrame, unit: str, period: str, value: str, treated, start, max_units: int = 500,
                      confidence: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(effect per period, weights and fit per unit).

    ``df`` is summed to one value per unit and period; what is missing or null counts
    as 0, and rows without unit or period take no part. Weights (>= 0, sum 1) over the
    other units minimise the squared distance before ``start``; they come from the
    inner products of the series alone. As placebos every other unit is treated in turn, with the
    same products. The interval of an effect removes the central ``confidence`` of the placebo gaps of its period.

    Effects: period, is_post, actual, counterfactual, effect, low, high. Units: unit, weight (in the mix
    of the treated one), pre_rmse, post_rmse, ratio, p_value (share of units whose
    ratio is at least this one's). At most ``max_units`` units are allowed, as units x
    units numbers reach the driver; a treated unit without rows, fewer than two others, or no
    period before ``start`` are errors.
    """
    panel = df.where(F.col(unit).isNotNull() & F.col(period).isNotNull()).groupBy(
        F.col(unit).alias("unit"), F.col(period).alias("period")).agg(
        F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("value"))
    panel = reliable_checkpoint(panel)
    units = [r[0] for r in panel.select("unit").distinct().orderBy("unit").limit(max_units + 1).collect()]
    if len(units) > max_units:
        raise ValueError(f"more than {max_units} units")
    if treated not in units or len(units) < 3:
        raise ValueError("the treated unit needs rows and at least two others")
    before = panel.where(F.col("period") < F.lit(start))
    if before.isEmpty():
        raise ValueError("no period before the start")
    gram, me = _gram(before, units), units.index(treated)
    mixes = []
    for t in range(len(units)):
        donors = [u for u in range(len(units)) if u not in (t, me)]
        # squared distance of a mix to the target: w'hw as the weights add up to 1
        h = gram[np.ix_(donors, donors)] - gram[donors, t][:, None] - gram[donors, t][None, :] + gram[t, t]
        mixes += [(units[t], units[d], float(w)) for d, w in zip(donors, nearest_mix(h)) if w > 0]
    spark = df.sparkSession
    kind = dict(panel.dtypes)["unit"]
    weights = spark.createDataFrame(mixes, f"target {kind}, unit {kind}, weight double")
    # all units x all periods, so that a period without rows of the target counts as well
    made = panel.join(F.broadcast(weights), "unit").groupBy("target", "period").agg(F.sum(F.col("weight") * F.col("value")).alias("made"))
    targets = F.explode(F.array(*[F.lit(u) for u in units])).alias("target")
    grid = panel.select("period").distinct().select("period", targets)
    gaps = (grid.join(panel.withColumnRenamed("unit", "target"), ["target", "period"], "left")
            .join(made, ["target", "period"], "left").fillna(0.0, ["value", "made"])
            .withColumn("gap", F.col("value") - F.col("made")))
    gaps = reliable_checkpoint(gaps.withColumn("is_post", F.col("period") >= F.lit(start)))
    mine, tail = F.col("target") == F.lit(treated), (1 - confidence) / 2
    effects = gaps.groupBy("period", "is_post").agg(
        F.max(F.when(mine, F.col("value"))).alias("actual"), F.max(F.when(mine, F.col("made"))).alias("counterfactual"),
        F.max(F.when(mine, F.col("gap"))).alias("effect"),
        F.percentile(F.when(~mine, F.col("gap")), F.lit(tail)).alias("_lo"),
        F.percentile(F.when(~mine, F.col("gap")), F.lit(1 - tail)).alias("_hi")).select(
        "period", "is_post", "actual", "counterfactual", "effect",
        (F.col("effect") - F.col("_hi")).alias("low"), (F.col("effect") - F.col("_lo")).alias("high"))

    def rmse(post):
        return F.sqrt(F.avg(F.when(F.col("is_post") == post, F.col("gap") * F.col("gap"))))

    fit = gaps.groupBy("target").agg(rmse(False).alias("pre_rmse"), rmse(True).alias("post_rmse"))
    ratio = F.when(F.col("pre_rmse") > 0, F.col("post_rmse") / F.col("pre_rmse")).otherwise(
        F.when(F.col("post_rmse") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
    fit = fit.withColumn("ratio", ratio)
    at_least = Window.orderBy(F.col("ratio").desc()).rangeBetween(Window.unboundedPreceding, 0)  # one row per unit
    fit = fit.withColumn("p_value", F.count(F.lit(1)).over(at_least) / F.lit(len(units)))
    own = weights.where(F.col("target") == F.lit(treated)).select(F.col("unit").alias("target"), "weight")
    return effects, fit.join(F.broadcast(own), "target", "left").select(
        F.col("target").alias("unit"), F.coalesce("weight", F.lit(0.0)).alias("weight"), "pre_rmse", "post_rmse", "ratio", "p_value")
