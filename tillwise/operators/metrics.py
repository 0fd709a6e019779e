"""Forecast, quantile and ranking metrics.

Every metric is one aggregation (partial aggregation map-side, then a final
merge), optionally grouped. Two aligned columns of one DataFrame replace the
reference's positional arrays; truth and prediction tables are joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numeric import safe_div
from tillwise.functions.prefix import ordered_prefix_sums


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------- K1-K4 expressions
def mape(y, p, percent: bool = False) -> Column:
    """K1: mean(|y-p|/|y|) over rows with y != 0."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    v = F.avg(F.when(y != 0, F.abs(y - p) / F.abs(y)))
    return v * 100 if percent else v


def smape(y, p, percent: bool = False, drop_both_zero: bool = False) -> Column:
    """K2: mean(2|y-p|/(|y|+|p|)); both-zero rows count 0 (or are dropped)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    den = F.abs(y) + F.abs(p)
    term = F.when(den != 0, 2.0 * F.abs(y - p) / den)
    if not drop_both_zero:
        term = term.otherwise(F.lit(0.0))
    v = F.avg(term)
    return v * 100 if percent else v


def wape(y, p, percent: bool = False, zero: float | None = None) -> Column:
    """K3: Σ|y-p| / Σ|y| (NULL, or ``zero``, when Σ|y| = 0)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    v = safe_div(F.sum(F.abs(y - p)), F.sum(F.abs(y)), zero)
    return v * 100 if percent else v


def bias(y, p, percent: bool = False, signed_den: bool = False, zero: float | None = None) -> Column:
    """K4: Σ(p-y) / Σ|y| (or Σy with ``signed_den``)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    den = F.sum(y) if signed_den else F.sum(F.abs(y))
    v = safe_div(F.sum(p - y), den, zero)
    return v * 100 if percent else v


def turnover_error(y, p) -> Column:
    """K5: mean(((y-p)/p)^2); rows with p = 0 are skipped (NULL)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    r = safe_div(y - p, p)
    return F.avg(r * r)


def ltv_error(y, p) -> Column:
    """K6: mean(((y-p)/y)^2 * p/y); rows with y = 0 are skipped (NULL)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    r = safe_div(y - p, y)
    return F.avg(r * r * safe_div(p, y))


def pinball(y, p, q: float) -> Column:
    """K7: mean(q*max(y-p,0) + (1-q)*max(p-y,0))."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    d = y - p
    return F.avg(F.lit(q) * F.greatest(d, F.lit(0.0)) + F.lit(1 - q) * F.greatest(-d, F.lit(0.0)))


# ------------------------------------------------------------------ operators
def forecast_errors(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None,
                    variant: str = "solution") -> DataFrame:
    """K1-K4 in one pass. ``variant='template'``: x100, both-zero sMAPE rows
    dropped, bias over Σy."""
    tmpl = variant == "template"
    return df.groupBy(*(by or [])).agg(
        mape(y, p, tmpl).alias("mape"),
        smape(y, p, tmpl, drop_both_zero=tmpl).alias("smape"),
        wape(y, p, tmpl).alias("wape"),
        bias(y, p, tmpl, signed_den=tmpl).alias("bias"))


def asymmetric_errors(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None) -> DataFrame:
    """K5 and K6."""
    return df.groupBy(*(by or [])).agg(turnover_error(y, p).alias("turnover_error"),
                                       ltv_error(y, p).alias("ltv_error"))


def pinball_loss(df: DataFrame, y: str, p: str, q: float, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(pinball(y, p, q).alias("pinball_loss"))


def pred_col(horizon: int, quantile_pct: int) -> str:
    """Prediction column name; quantiles are whole per cents (8.9)."""
    return f"pred_{horizon}d_q{quantile_pct}"


def evaluate_quantiles(df: DataFrame, quantiles=(10, 50, 90), horizons=(7, 14, 21),
                       target: str = "next_{h}d") -> DataFrame:
    """K8: pinball loss per (quantile, horizon) over a joined truth+prediction
    frame, as one aggregation with 9 expressions, then unpivoted."""
    aggs = []
    for q in quantiles:
        for h in horizons:
            aggs.append(pinball(target.format(h=h), pred_col(h, q), q / 100).alias(f"l_{q}_{h}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"{q / 100}D, {h}, l_{q}_{h}" for q in quantiles for h in horizons)
    return wide.selectExpr(f"stack({len(aggs)}, {stack}) as (quantile, horizon, avg_quantile_loss)")


def losses_ok(losses: DataFrame) -> DataFrame:
    """K9: false if any loss is NULL/NaN or negative."""
    l = F.col("avg_quantile_loss")
    bad = l.isNull() | F.isnan(l) | (l < 0)
    return losses.agg(F.coalesce(F.bool_and(~bad), F.lit(True)).alias("losses_ok"))


# ------------------------------------------------------------ K10-K13 curves
def score_curve(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """K13 core: one row per distinct score (descending) with per-score and
    cumulative positive / negative counts; ties are grouped by equal score.

    Rows are first reduced to one row per score (map-side partial counts); the
    running sums then use range partitions, not a single-task window.
    """
    g = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg"))
    return ordered_prefix_sums(g, [F.col("threshold").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})


def class_totals(df: DataFrame, label: str = "y") -> tuple[int, int]:
    """(positives, negatives): one bounded scalar row fetched to the driver."""
    r = df.agg(F.sum(F.col(label).cast("long")).alias("p"),
               F.sum(1 - F.col(label).cast("long")).alias("n")).first()
    return int(r["p"] or 0), int(r["n"] or 0)


def curve_table(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """Curve points (threshold, tp, fp, precision, recall, fpr)."""
    n_pos, n_neg = class_totals(df, label)
    cum = score_curve(df, label, score)
    recall = (F.col("tp") / F.lit(n_pos)) if n_pos else F.lit(1.0)
    fpr = (F.col("fp") / F.lit(n_neg)) if n_neg else F.lit(None).cast("double")
    return cum.select(
        "threshold", "pos", "neg", "tp", "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        recall.alias("recall"), fpr.alias("fpr"))


def classification_report(df: DataFrame, label: str = "y", score: str = "score",
                          min_precision: float = 0.95, min_specificity: float = 0.95) -> DataFrame:
    """One row with roc_auc (tie-aware rank statistic),
    recall@precision and recall@specificity over the full curve."""
    n_pos, n_neg = class_totals(df, label)
    c = curve_table(df, label, score)
    auc_term = F.col("pos") * (F.lit(n_neg) - F.col("fp") + 0.5 * F.col("neg"))
    auc = (F.sum(auc_term) / F.lit(float(n_pos * n_neg))) if n_pos and n_neg else F.lit(None).cast("double")
    max_fpr = 1 - min_specificity
    return c.agg(
        auc.alias("roc_auc"),
        F.coalesce(F.max(F.when(F.col("precision") >= min_precision, F.col("recall"))),
                   F.lit(0.0)).alias("recall_at_precision"),
        F.coalesce(F.max(F.when(F.col("fpr") <= F.lit(max_fpr), F.col("recall"))), F.lit(0.0))
        .alias("recall_at_specificity"))


# ------------------------------------------------------------------- K15
def weighted_margin(plan: DataFrame, by: list[str] | None = None, strict_positive: bool = True) -> DataFrame:
    """Σ(gmv·margin)/Σgmv; 0 when Σgmv <= 0 (or == 0)."""
    tot = F.sum("gmv")
    num = F.sum(F.col("gmv") * F.col("margin"))
    cond = tot <= 0 if strict_positive else tot == 0
    return plan.groupBy(*(by or [])).agg(
        F.when(F.coalesce(cond, F.lit(True)), F.lit(0.0)).otherwise(num / tot).alias("weighted_margin"))


# ------------------------------------------------------- T16 / T17 ranking
def ranking_metrics(df: DataFrame, group: str, score: str, rel: str, item: str, k: int = 10) -> DataFrame:
    """NDCG@k and recall@k per group (query): DCG of the top-k by score,
    IDCG of the top-k by relevance; both top-k use the salted two-stage
    ranking so a huge group is not sorted in one task."""
    from tillwise.functions.topk import top_k_per_group
    by_score = top_k_per_group(df, [group], [F.col(score).desc(), F.col(item).asc()], k, "rank")
    ideal = top_k_per_group(df, [group], [F.col(rel).desc(), F.col(item).asc()], k, "rank")
    gain = F.col(rel).cast("double") / F.log2(F.col("rank") + 1.0)
    dcg = by_score.groupBy(group).agg(F.sum(gain).alias("dcg"), F.sum(F.col(rel).cast("double")).alias("hits"))
    idcg = ideal.groupBy(group).agg(F.sum(gain).alias("idcg"))
    tot = df.groupBy(group).agg(F.sum(F.col(rel).cast("double")).alias("relevant"), F.count(F.lit(1)).alias("n"))
    j = tot.join(dcg, group).join(idcg, group)
    return j.select(group, "n", "relevant", safe_div(F.col("dcg"), F.col("idcg")).alias(f"ndcg_at_{k}"),
                    safe_div(F.col("hits"), F.col("relevant")).alias(f"recall_at_{k}"))
