"""Rule-based data-quality table (T42): completeness, uniqueness, range and
freshness checks computed in one aggregation and unpivoted to one row per
rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_rules(df: DataFrame, not_null: list[str], unique: str, positive: list[str], fresh_col: str,
             reference_day, max_lag_days: int = 30) -> DataFrame:
    """Returns (rule, column, value, passed)."""
    n = F.count(F.lit(1))
    aggs, meta = [], []
    for c in not_null:
        aggs.append((F.count(c) / n).alias(f"complete_{c}"))
        meta.append(("completeness", c, f"complete_{c}", "= 1"))
    aggs.append((F.countDistinct(unique) / n).alias(f"unique_{unique}"))
    meta.append(("uniqueness", unique, f"unique_{unique}", "= 1"))
    for c in positive:
        aggs.append(F.avg(F.when(F.col(c) > 0, 1.0).otherwise(0.0)).alias(f"positive_{c}"))
        meta.append(("range_positive", c, f"positive_{c}", "= 1"))
    aggs.append(F.datediff(F.lit(reference_day), F.max(F.to_date(fresh_col))).cast("double").alias("lag_days"))
    meta.append(("freshness_days", fresh_col, "lag_days", f"<= {max_lag_days}"))
    row = df.agg(*aggs)
    stack = ", ".join(f"'{r}', '{c}', cast({a} as double), {a} {cond}" for r, c, a, cond in meta)
    return row.selectExpr(f"stack({len(meta)}, {stack}) as (rule, column, value, passed)")
