"""File sources and sinks.

Readers use explicit schemas (no inference pass over the data); JSON inputs
with nested lists are exploded into flat tables with Spark generators, so the
documents are parsed by executors, never on the driver.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.dates import parse_time


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A1: CSV with header. With no schema every column is read as string
    (typed later by explicit casts) instead of an inference pass."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def with_parsed_time(df: DataFrame, col: str, out: str | None = None, day_first: bool = False) -> DataFrame:
    """A2: parse a timestamp string column; unparsable values become NULL."""
    return df.withColumn(out or col, parse_time(col, day_first))


# ---------------------------------------------------------------- A3 delivery
DELIVERY_SCHEMA = T.StructType([
    T.StructField("forecast_demand", T.ArrayType(T.StructType([
        T.StructField("product", T.StringType()),
        T.StructField("marketplace", T.StringType()),
        T.StructField("forecast_percentiles", T.MapType(T.StringType(), T.DoubleType()))]))),
    T.StructField("warehouse_stocks", T.ArrayType(T.StructType([
        T.StructField("product", T.StringType()),
        T.StructField("quantity", T.LongType())]))),
    T.StructField("bundle_sizes", T.ArrayType(T.StructType([
        T.StructField("product", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("quantity", T.LongType())]))),
    T.StructField("transport_costs", T.ArrayType(
        T.MapType(T.StringType(), T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))))),
])

DELIVERY_KEYS = ("forecast_demand", "warehouse_stocks", "bundle_sizes", "transport_costs")


def _last_wins(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the entry with the highest list position per key (later duplicate wins)."""
    w = Window.partitionBy(*keys).orderBy(F.col("_doc").desc(), F.col("_pos").desc())
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_pos", "_doc")


def load_delivery_json(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A3: one (multi-line) JSON object per file with four lists.

    Returns ``forecast`` (product, marketplace, percentile, demand), ``stock``,
    ``bundles``, ``costs`` and ``products`` (sorted distinct union, G2).
    A missing top-level key raises ``KeyError``.
    """
    # only the names of the top-level keys are read; no schema is inferred
    names = spark.read.text(path, wholetext=True).select(F.explode(F.json_object_keys("value")).alias("k"))
    present = {r["k"] for r in names.where(F.col("k").isin(*DELIVERY_KEYS)).distinct().collect()}
    missing = [k for k in DELIVERY_KEYS if k not in present]
    if missing:
        raise KeyError(f"Missing required key: {missing[0]}")
    doc = (spark.read.option("multiLine", True).schema(DELIVERY_SCHEMA).json(path)
           .withColumn("_doc", F.monotonically_increasing_id()))
    fd = doc.select("_doc", F.posexplode("forecast_demand").alias("_pos", "r")).select("_doc", "_pos", "r.*")
    fd = _last_wins(fd, ["product", "marketplace"])
    forecast = fd.select("product", "marketplace",
                         F.explode("forecast_percentiles").alias("percentile", "demand"))
    st = doc.select("_doc", F.posexplode("warehouse_stocks").alias("_pos", "r")).select("_doc", "_pos", "r.*")
    stock = _last_wins(st, ["product"])
    bs = doc.select("_doc", F.posexplode("bundle_sizes").alias("_pos", "r")).select("_doc", "_pos", "r.*")
    bundles = _last_wins(bs, ["product", "type"])
    tc = doc.select("_doc", F.posexplode("transport_costs").alias("_pos", "m"))
    tc = tc.select("_doc", "_pos", F.explode("m").alias("product", "mp"))
    tc = tc.select("_doc", "_pos", "product", F.explode("mp").alias("marketplace", "costs"))
    costs = _last_wins(tc, ["product", "marketplace"]).select(
        "product", "marketplace", F.explode("costs").alias("type", "cost"))
    products = key_union([forecast, stock, bundles, costs], "product")
    return {"forecast": forecast, "stock": stock, "bundles": bundles, "costs": costs, "products": products}


def key_union(frames: list[DataFrame], key: str) -> DataFrame:
    """Sorted distinct union of the key column of several tables."""
    u = frames[0].select(key)
    for f in frames[1:]:
        u = u.unionByName(f.select(key))
    return u.distinct().orderBy(key)


# ----------------------------------------------------------------- A4 restock
RESTOCK_SCHEMA = T.StructType([
    T.StructField("sku_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("current_stock", T.LongType()),
    T.StructField("storage_time", T.DoubleType()),
    T.StructField("percentiles", T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))),
])


def load_restock_json(spark: SparkSession, path: str) -> DataFrame:
    """A4: JSON list of products with ``percentiles{week{pct: demand}}``,
    exploded to (sku_id, weeks, percentile, demand, ...)."""
    df = spark.read.option("multiLine", True).schema(RESTOCK_SCHEMA).json(path)
    wk = df.select("*", F.explode("percentiles").alias("week", "pm"))
    flat = wk.select("sku_id", "price", "cost", "current_stock", "storage_time",
                     F.regexp_extract("week", r"^(\d+)w$", 1).cast("int").alias("weeks"),
                     F.explode("pm").alias("pct", "demand"))
    return flat.select("sku_id", "weeks", F.col("pct").cast("int").alias("percentile"), "price", "cost",
                       "current_stock", "storage_time", "demand")


def restock_nested(df: DataFrame) -> DataFrame:
    """Inverse of the explode: one row per sku with the nested percentile map."""
    inner = df.groupBy("sku_id", "price", "cost", "current_stock", "storage_time", "weeks").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("percentile").cast("string"), "demand"))).alias("pm"))
    return inner.groupBy("sku_id", "price", "cost", "current_stock", "storage_time").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat(F.col("weeks").cast("string"), F.lit("w")), "pm")))
        .alias("percentiles"))


# ------------------------------------------------------------------- A6-A10
def write_tables(tables: dict[str, DataFrame], outdir: str, fmt: str = "parquet",
                 mode: str = "overwrite") -> dict[str, str]:
    """Write each result table to ``outdir/name``; returns the paths."""
    paths = {}
    for name, df in tables.items():
        if df is None:
            continue
        p = os.path.join(outdir, name)
        w = df.write.mode(mode)
        if fmt == "csv":
            w.option("header", True).csv(p)
        else:
            w.format(fmt).save(p)
        paths[name] = p
    return paths


def alert_report(alerts: DataFrame, meta: dict) -> tuple[DataFrame, DataFrame]:
    """Alerts stay a table; run metadata becomes a one-row table."""
    spark = alerts.sparkSession
    fields = [T.StructField(k, T.StringType()) for k in meta]
    meta_df = spark.createDataFrame([tuple(str(v) for v in meta.values())], T.StructType(fields))
    return alerts, meta_df


def save_model_table(coefs: DataFrame, path: str) -> None:
    """Persist a fitted-coefficient table as parquet."""
    coefs.write.mode("overwrite").parquet(path)


def load_model_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


PREDICTION_REQUIRED = ("sku_id",)


def upload_predictions(pred: DataFrame, path: str) -> None:
    """Replace the served predictions table (schema-checked overwrite)."""
    missing = [c for c in PREDICTION_REQUIRED if c not in pred.columns]
    if missing or not any(c.startswith("pred_") for c in pred.columns):
        raise ValueError("predictions need sku_id and pred_* columns")
    pred.write.mode("overwrite").parquet(path)


def read_thresholds(path: str) -> dict:
    """A10: thresholds file (YAML, or JSON when PyYAML is absent) read on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml  # type: ignore
        return yaml.safe_load(text)
    except ImportError:
        return json.loads(text)
