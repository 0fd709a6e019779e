"""Group-mean imputation (M1, E8, D11) and loan features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import days_between
from tillwise.functions.numeric import nan_to_null


def _check(df: DataFrame, target: str, group: str) -> None:
    if target not in df.columns:
        raise KeyError(f"target column '{target}' not found")
    if group not in df.columns:
        raise KeyError(f"group column '{group}' not found")


def _means(df: DataFrame, target: str, group: str) -> DataFrame:
    """Per-group means by partial aggregation (a hot group is combined
    map-side), joined back by group: the small side is broadcast by AQE after
    it is measured, and a hot key on the large side is split by skew join."""
    return df.groupBy(F.col(group).alias("_g")).agg(F.avg(nan_to_null(target)).alias("_m"))


def _with_mean(df: DataFrame, target: str, group: str) -> DataFrame:
    m = _means(df, target, group)
    return df.join(m, df[group].eqNullSafe(m["_g"]), "left").drop("_g")


def group_mean(df: DataFrame, target: str, group: str, out: str = "group_mean") -> DataFrame:
    """Per-group mean attached to every row."""
    _check(df, target, group)
    cols = df.columns
    return _with_mean(df, target, group).select(*cols, F.col("_m").alias(out))


def group_mean_fill(df: DataFrame, target: str, group: str) -> DataFrame:
    """NULL/NaN values replaced by the group mean (groups of only missing
    values stay NULL)."""
    _check(df, target, group)
    cols = df.columns
    j = _with_mean(df, target, group)
    return j.select(*[F.coalesce(nan_to_null(target), F.col("_m")).alias(c) if c == target else F.col(c)
                      for c in cols])


def fill_group_mean_floor(df: DataFrame, target: str, group: str, floor_all: bool = False) -> DataFrame:
    """M1: fill missing values with ``floor(group mean)``; existing values are
    kept (documented behaviour) or floored too (``floor_all=True``, the
    ``src`` variant)."""
    _check(df, target, group)
    cols = df.columns
    j = _with_mean(df, target, group)
    v, m = nan_to_null(target), F.col("_m")
    if floor_all:
        filled = F.floor(F.coalesce(v, m)).cast("double")
    else:
        filled = F.coalesce(v, F.floor(m).cast("double"))
    return j.select(*[filled.alias(c) if c == target else F.col(c) for c in cols])


LOAN_FEATURES = ["age", "income", "dependents", "has_property", "has_car", "credit_score", "job_tenure",
                 "has_education", "loan_amount"]


def loan_features(df: DataFrame) -> DataFrame:
    """Passthrough features present in the input, ``loan_period`` =
    deadline - start in days, ``delay_days`` = 0 when paid by the deadline
    else paid - deadline; ordered by id."""
    feats = [c for c in LOAN_FEATURES if c in df.columns]
    delay = F.when(F.col("loan_payed") <= F.col("loan_deadline"), F.lit(0)).otherwise(
        days_between("loan_deadline", "loan_payed"))
    return df.select("id", *feats, days_between("loan_start", "loan_deadline").alias("loan_period"),
                     delay.alias("delay_days")).orderBy("id")
