"""Column contracts (B6) checked on the driver before any job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(df: DataFrame, cols, what: str = "input") -> None:
    """Raise ``ValueError`` naming the missing columns (schema only, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in {what}: {missing}")


def has_column(df: DataFrame, col: str) -> bool:
    return col in df.columns


SKU_DAY = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("sku", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("stock", T.LongType()),
    T.StructField("forecast_gmv", T.DoubleType()),
    T.StructField("actual_units", T.LongType()),
])

PRICE_CANDIDATES = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("cost", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("qty", T.StringType()),
    T.StructField("scenario_id", T.StringType()),
])
