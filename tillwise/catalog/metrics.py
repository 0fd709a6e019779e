"""Registered metric queries (fixtures ``fx_forecast_pairs``, ``fx_scored``)."""

from __future__ import annotations

from tillwise.catalog.base import query
from tillwise.operators import metrics as m
from tillwise.sources.fixtures import fx_forecast_pairs, fx_scored

MAPE = "avg(case when y <> 0 then abs(y - p) / abs(y) end)"
SMAPE = "avg(case when abs(y) + abs(p) <> 0 then 2.0 * abs(y - p) / (abs(y) + abs(p)) else 0.0 end)"
WAPE = "case when sum(abs(y)) <> 0 then sum(abs(y - p)) / sum(abs(y)) end"
BIAS = "case when sum(abs(y)) <> 0 then sum(p - y) / sum(abs(y)) end"


@query("mape", sql=f"select {MAPE} as mape from fx_forecast_pairs", doubles=("mape",))
def q_mape(spark, sf_dir):
    return fx_forecast_pairs(spark, sf_dir).agg(m.mape("y", "p").alias("mape"))


@query("smape", sql=f"select {SMAPE} as smape from fx_forecast_pairs", doubles=("smape",))
def q_smape(spark, sf_dir):
    return fx_forecast_pairs(spark, sf_dir).agg(m.smape("y", "p").alias("smape"))


@query("wape", sql=f"select {WAPE} as wape from fx_forecast_pairs", doubles=("wape",))
def q_wape(spark, sf_dir):
    return fx_forecast_pairs(spark, sf_dir).agg(m.wape("y", "p").alias("wape"))


@query("bias", sql=f"select {BIAS} as bias from fx_forecast_pairs", doubles=("bias",))
def q_bias(spark, sf_dir):
    return fx_forecast_pairs(spark, sf_dir).agg(m.bias("y", "p").alias("bias"))


@query("forecast_errors_template",
       sql="""select avg(case when y <> 0 then abs(y - p) / abs(y) end) * 100 as mape,
                     avg(case when abs(y) + abs(p) <> 0 then 2 * abs(y - p) / (abs(y) + abs(p)) end) * 100 as smape,
                     case when sum(abs(y)) <> 0 then sum(abs(y - p)) / sum(abs(y)) end * 100 as wape,
                     case when sum(y) <> 0 then sum(p - y) / sum(y) end * 100 as bias
              from fx_forecast_pairs""",
       doubles=("mape", "smape", "wape", "bias"))
def q_forecast_errors_template(spark, sf_dir):
    return m.forecast_errors(fx_forecast_pairs(spark, sf_dir), variant="template")


@query("error_by_segment",
       sql=f"""select segment, {MAPE} as mape, {SMAPE} as smape, {WAPE} as wape, {BIAS} as bias
               from fx_forecast_pairs group by segment order by wape desc""",
       doubles=("mape", "smape", "wape", "bias"))
def q_error_by_segment(spark, sf_dir):
    """K1-K4 per segment, worst WAPE first."""
    return m.forecast_errors(fx_forecast_pairs(spark, sf_dir), by=["segment"]).orderBy("wape", ascending=False)


@query("turnover_error",
       sql="select avg(((y - p) / p) * ((y - p) / p)) as turnover_error from fx_forecast_pairs where p <> 0",
       doubles=("turnover_error",))
def q_turnover_error(spark, sf_dir):
    return fx_forecast_pairs(spark, sf_dir).agg(m.turnover_error("y", "p").alias("turnover_error"))


@query("ltv_error",
       sql="select avg(((y - p) / y) * ((y - p) / y) * (p / y)) as ltv_error from fx_forecast_pairs where y <> 0",
       doubles=("ltv_error",))
def q_ltv_error(spark, sf_dir):
    return fx_forecast_pairs(spark, sf_dir).agg(m.ltv_error("y", "p").alias("ltv_error"))


@query("pinball_loss",
       sql="""select segment, avg(0.9 * greatest(y - p, 0.0) + (1 - 0.9) * greatest(p - y, 0.0)) as pinball_loss
              from fx_forecast_pairs group by segment""",
       doubles=("pinball_loss",))
def q_pinball_loss(spark, sf_dir):
    return m.pinball_loss(fx_forecast_pairs(spark, sf_dir), "y", "p", 0.9, by=["segment"])


CURVE_SQL = """
with g as (select score as threshold, sum(cast(y as bigint)) as pos, sum(1 - cast(y as bigint)) as neg
           from fx_scored group by score),
     t as (select sum(pos) as n_pos, sum(neg) as n_neg from g),
     c as (select threshold, pos, neg,
                  sum(pos) over (order by threshold desc rows between unbounded preceding and current row) as tp,
                  sum(neg) over (order by threshold desc rows between unbounded preceding and current row) as fp
           from g),
     curve as (select threshold, pos, neg, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
                      tp / (tp + fp) as precision,
                      case when n_pos > 0 then tp / n_pos else 1.0 end as recall,
                      case when n_neg > 0 then fp / n_neg end as fpr, n_pos, n_neg
               from c, t)"""


@query("pr_roc_points",
       sql=CURVE_SQL + " select threshold, cast(pos as bigint) as pos, cast(neg as bigint) as neg, tp, fp, "
                       "precision, recall, fpr from curve",
       doubles=("threshold", "precision", "recall", "fpr"))
def q_pr_roc_points(spark, sf_dir):
    return m.curve_table(fx_scored(spark, sf_dir))


@query("recall_at_precision",
       sql=CURVE_SQL + """ select coalesce(max(case when precision >= 0.95 then recall end), 0.0)
                            as recall_at_precision from curve""",
       doubles=("recall_at_precision",))
def q_recall_at_precision(spark, sf_dir):
    return m.classification_report(fx_scored(spark, sf_dir)).select("recall_at_precision")


@query("recall_at_specificity",
       sql=CURVE_SQL + """ select coalesce(max(case when fpr <= 1 - 0.95 then recall end), 0.0)
                            as recall_at_specificity from curve""",
       doubles=("recall_at_specificity",))
def q_recall_at_specificity(spark, sf_dir):
    return m.classification_report(fx_scored(spark, sf_dir)).select("recall_at_specificity")


AUC_SQL = "sum(pos * (n_neg - fp + 0.5 * neg)) / (max(n_pos) * max(n_neg))"


@query("roc_auc", sql=CURVE_SQL + f" select {AUC_SQL} as roc_auc from curve", doubles=("roc_auc",))
def q_roc_auc(spark, sf_dir):
    return m.classification_report(fx_scored(spark, sf_dir)).select("roc_auc")


@query("fraud_report",
       sql=CURVE_SQL + f""" select {AUC_SQL} as roc_auc,
              coalesce(max(case when precision >= 0.95 then recall end), 0.0) as recall_at_precision,
              coalesce(max(case when fpr <= 1 - 0.95 then recall end), 0.0) as recall_at_specificity
              from curve""",
       doubles=("roc_auc", "recall_at_precision", "recall_at_specificity"))
def q_fraud_report(spark, sf_dir):
    """L13 shape: the three ranking metrics of a scored table in one row."""
    return m.classification_report(fx_scored(spark, sf_dir))
