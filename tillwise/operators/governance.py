"""Forecast governance under stock limits.

The SKU-day table is processed with narrow projections (one codegen stage) and
single-pass aggregations; nothing here joins the table with itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import week_key
from tillwise.schemas import require_columns

GOV_REQUIRED = ["date", "sku", "category", "price", "stock", "forecast_gmv"]

# Default alert thresholds of the governance job
DEFAULT_THRESHOLDS = {
    "supply": {"lost_sales_gmv_week_min": 1000000, "oos_rate_multiplier": 1.3},
    "model": {"wape_delta": 0.05, "min_units_for_evaluation": 5000},
    "data": {"max_price": 10000000, "max_stock": 1000000},
}

# Alert texts of the weekly governance report, then owner and action, by type
ALERT_TEXTS = {
    "SUPPLY": "High lost sales due to OOS: %s GMV (period total).",
    "MODEL": "Non-OOS WAPE is elevated: %.3f.",
    "DATA": "Extreme price values detected (above max_price).",
}
ALERT_OWNERS = {
    "SUPPLY": ("Supply/Logistics", "Review top SKUs by lost_sales_gmv; expedite inbound / redistribute / adjust safety stock."),
    "MODEL": ("Forecast Owner (Planning/DS)", "Check promo factors, seasonality, price elasticity; review recent data changes."),
    "DATA": ("DWH/Source Systems", "Validate price feed; check currency/scale issues; correct upstream mapping."),
}


def coerce_types(df: DataFrame) -> DataFrame:
    """Strict casts (fail fast under ANSI); ``actual_units`` NULL -> 0."""
    require_columns(df, GOV_REQUIRED, "sku-day table")
    cols = [F.to_date("date").alias("date"), F.col("sku").cast("long").alias("sku"),
            F.col("category").cast("string").alias("category"),
            F.col("price").cast("double").alias("price"), F.col("stock").cast("long").alias("stock"),
            F.col("forecast_gmv").cast("double").alias("forecast_gmv")]
    if "actual_units" in df.columns:
        cols.append(F.coalesce(F.col("actual_units").cast("long"), F.lit(0)).alias("actual_units"))
    rest = [c for c in df.columns if c not in GOV_REQUIRED + ["actual_units"]]
    return df.select(*cols, *rest)


def validation_counts(df: DataFrame) -> DataFrame:
    """One row with the number of rows breaking each rule (one pass)."""
    require_columns(df, GOV_REQUIRED, "sku-day table")
    return df.agg(
        F.count_if(F.col("price") <= 0).alias("n_price_le_0"),
        F.count_if(F.col("stock") < 0).alias("n_stock_lt_0"),
        F.count_if(F.col("date").isNull() | F.col("sku").isNull()).alias("n_null_key"),
        F.count(F.lit(1)).alias("n_rows"))


def validate_input(df: DataFrame) -> None:
    """Raise with up to 10 example rows; the samples are fetched only on failure."""
    row = validation_counts(df).first()
    if row["n_price_le_0"]:
        bad = df.where(F.col("price") <= 0).select("date", "sku", "price").limit(10).collect()
        raise ValueError(f"Invalid price (<=0) detected. Examples: {bad}")
    if row["n_stock_lt_0"]:
        bad = df.where(F.col("stock") < 0).select("date", "sku", "stock").limit(10).collect()
        raise ValueError(f"Invalid stock (<0) detected. Examples: {bad}")
    if row["n_null_key"]:
        raise ValueError("Nulls detected in key columns (date, sku).")


def _forecast_units(gmv: Column, price: Column) -> Column:
    units = F.when(price > 0, F.floor(gmv / price)).otherwise(F.lit(0)).cast("long")
    return F.greatest(units, F.lit(0).cast("long"))


def feasible_plan(df: DataFrame) -> DataFrame:
    """M2: GMV forecast -> integer units, capped by stock."""
    require_columns(df, ["forecast_gmv", "price", "stock"])
    units = _forecast_units(F.col("forecast_gmv"), F.col("price"))
    out = df.withColumn("forecast_units", units)
    feas = F.greatest(F.least(F.col("forecast_units"), F.col("stock")), F.lit(0).cast("long"))
    return (out.withColumn("feasible_units", feas)
            .withColumn("feasible_gmv", F.col("feasible_units") * F.col("price"))
            .withColumn("is_stock_constrained", F.col("forecast_units") > F.col("stock")))


def lost_sales(df: DataFrame) -> DataFrame:
    """M3: units above stock and their value."""
    require_columns(df, ["forecast_units", "stock", "price"])
    lost = F.greatest(F.col("forecast_units") - F.col("stock"), F.lit(0).cast("long"))
    return (df.withColumn("lost_sales_units", lost)
            .withColumn("lost_sales_gmv", F.col("lost_sales_units") * F.col("price")))


def feasible_plan_flat(df: DataFrame, gmv: str = "gmv") -> DataFrame:
    """M4: one-step variant; feasible units are not clamped at 0."""
    require_columns(df, [gmv, "price", "stock"])
    out = df.withColumn("units_forecast", _forecast_units(F.col(gmv), F.col("price")))
    out = out.withColumn("units_feasible", F.least(F.col("units_forecast"), F.col("stock")))
    out = out.withColumn("gmv_feasible", F.col("units_feasible") * F.col("price"))
    lost = F.greatest(F.col("units_forecast") - F.col("units_feasible"), F.lit(0).cast("long"))
    return (out.withColumn("lost_sales_units", lost)
            .withColumn("lost_sales_gmv", F.col("lost_sales_units") * F.col("price")))


def enrich(df: DataFrame) -> DataFrame:
    """M2 + M3 + actual GMV when actual units are present."""
    out = lost_sales(feasible_plan(df))
    if "actual_units" in out.columns:
        out = out.withColumn("actual_gmv", F.col("actual_units") * F.col("price"))
    return out


def _wape_bias(actual: Column, forecast: Column, keep: Column | None = None):
    """Σ|a−f|/Σ|a| and Σ(f−a)/Σa, each 0 when its denominator is 0."""
    def s(x):
        return F.sum(x if keep is None else F.when(keep, x))
    den_w, den_b = s(F.abs(actual)), s(actual)
    wape = F.when(F.coalesce(den_w, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(s(F.abs(actual - forecast)) / den_w)
    bias = F.when(F.coalesce(den_b, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(s(forecast - actual) / den_b)
    return wape, bias


def quality_metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame | None:
    """Raw and non-stock-constrained WAPE / bias in one aggregation.

    Returns ``None`` when the table has no ``actual_units`` column.
    """
    if "actual_units" not in df.columns:
        return None
    a = F.col("actual_units").cast("double")
    f = F.col("forecast_units").cast("double")
    w_raw, b_raw = _wape_bias(a, f)
    w_ok, b_ok = _wape_bias(a, f, ~F.col("is_stock_constrained"))
    aggs = [w_raw.alias("wape_raw"), b_raw.alias("bias_raw"),
            w_ok.alias("wape_non_oos"), b_ok.alias("bias_non_oos")]
    return df.groupBy(*(by or [])).agg(*aggs)


def alerts(df: DataFrame, thresholds: dict | None = None, by: list[str | Column] | None = None) -> DataFrame:
    """M5 (as coded): SUPPLY / MODEL / DATA alerts from one aggregation row, or one for each group of ``by``.

    The alert rows are produced by exploding an array of optional structs, so
    the whole rule set is one job over the daily table.
    """
    th = thresholds or DEFAULT_THRESHOLDS
    a = F.col("actual_units").cast("double") if "actual_units" in df.columns else None
    f = F.col("forecast_units").cast("double")
    aggs = [F.coalesce(F.sum("lost_sales_gmv"), F.lit(0.0)).alias("lost"),
            F.max(F.col("price") > F.lit(float(th["data"]["max_price"]))).alias("bad_price")]
    if a is not None:
        w_raw, _ = _wape_bias(a, f)
        w_ok, _ = _wape_bias(a, f, ~F.col("is_stock_constrained"))
        aggs += [w_raw.alias("wape_raw"), w_ok.alias("wape_non_oos")]
    else:
        aggs += [F.lit(0.0).alias("wape_raw"), F.lit(0.0).alias("wape_non_oos")]
    row = df.groupBy(*(by or [])).agg(*aggs)
    groups = row.columns[:len(by or [])]

    def alert(cond, level, typ, message, owner, action):
        return F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(typ).alias("type"),
                                     message.alias("message"), F.lit(owner).alias("owner"),
                                     F.lit(action).alias("action")))

    supply = alert(F.col("lost") >= F.lit(float(th["supply"]["lost_sales_gmv_week_min"])),
                   "CRIT", "SUPPLY",
                   F.format_string(ALERT_TEXTS["SUPPLY"],
                                   F.format_number("lost", 0)),
                   *ALERT_OWNERS["SUPPLY"])
    model = alert(F.col("wape_non_oos") >= F.lit(float(th["model"]["wape_delta"])) + F.col("wape_raw"),
                  "WARN", "MODEL",
                  F.format_string(ALERT_TEXTS["MODEL"], F.col("wape_non_oos")),
                  *ALERT_OWNERS["MODEL"])
    data = alert(F.coalesce(F.col("bad_price"), F.lit(False)), "WARN", "DATA",
                 F.lit(ALERT_TEXTS["DATA"]),
                 *ALERT_OWNERS["DATA"])
    return row.select(*groups, F.explode(F.array_compact(F.array(supply, model, data))).alias("a")).select(*groups, "a.*")


def weekly_summary_sql(df: DataFrame) -> DataFrame:
    """Sunday-start weeks per category, ordered week desc, loss desc."""
    wk = week_key("date", "sunday_start").alias("week")
    return (df.groupBy(wk, "category")
            .agg(F.sum("lost_sales_gmv").alias("lost_sales_gmv"),
                 F.avg(F.col("is_stock_constrained").cast("int")).alias("oos_rate"),
                 F.sum("actual_units").alias("actual_units"))
            .orderBy(F.col("week").desc(), F.col("lost_sales_gmv").desc()))


def weekly_summary_demo(df: DataFrame) -> DataFrame:
    """Monday-Sunday period label per category with GMV sums."""
    wk = week_key("date", "mon_sun_label").alias("week")
    return (df.groupBy(wk, "category")
            .agg(F.sum("lost_sales_gmv").alias("lost_sales_gmv"),
                 F.avg(F.col("is_stock_constrained").cast("int")).alias("oos_rate"),
                 F.sum("feasible_gmv").alias("feasible_gmv"),
                 F.sum("forecast_gmv").alias("forecast_gmv"))
            .orderBy(F.col("week").desc(), F.col("lost_sales_gmv").desc()))


def weekly_kpis(df: DataFrame, by: list[str] | None = None, week_mode: str = "monday") -> DataFrame:
    """Weekly OOS rate, lost GMV, non-OOS WAPE and volume per key."""
    by = by or []
    a = F.col("actual_units").cast("double")
    f = F.col("forecast_units").cast("double")
    ok = ~F.col("is_stock_constrained")
    w_ok, _ = _wape_bias(a, f, ok)
    return df.groupBy(*by, week_key("date", week_mode).alias("week")).agg(
        F.avg(F.col("is_stock_constrained").cast("int")).alias("oos_rate"),
        F.sum("lost_sales_gmv").alias("lost_sales_gmv"),
        w_ok.alias("wape_non_oos"),
        F.sum(F.when(ok, F.col("actual_units"))).alias("units_non_oos"))


def rolling_baseline(df: DataFrame, value: str, by: list[str], order: str = "week",
                     weeks: int = 4, out: str | None = None) -> DataFrame:
    """Average of the previous ``weeks`` rows (current week excluded)."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-weeks, -1)
    return df.withColumn(out or f"{value}_{weeks}w_avg", F.avg(value).over(w))


def weekly_alerts(df: DataFrame, thresholds: dict | None = None, by: list[str] | None = None) -> DataFrame:
    """M6 (as documented): per key and week, compare with the 4-week average.

    SUPPLY: oos_rate > multiplier x 4-week mean and lost GMV > threshold.
    MODEL: non-OOS WAPE > 4-week mean + delta and non-OOS units > minimum.
    The window is partitioned by the key; weeks per key are few.
    """
    th = thresholds or DEFAULT_THRESHOLDS
    by = by or ["category"]
    k = weekly_kpis(df, by)
    k = rolling_baseline(k, "oos_rate", by, out="oos_rate_4w_avg")
    k = rolling_baseline(k, "wape_non_oos", by, out="wape_non_oos_4w_avg")
    supply = ((F.col("oos_rate") > F.lit(float(th["supply"]["oos_rate_multiplier"])) * F.col("oos_rate_4w_avg"))
              & (F.col("lost_sales_gmv") > F.lit(float(th["supply"]["lost_sales_gmv_week_min"]))))
    model = ((F.col("wape_non_oos") > F.col("wape_non_oos_4w_avg") + F.lit(float(th["model"]["wape_delta"])))
             & (F.col("units_non_oos") > F.lit(int(th["model"]["min_units_for_evaluation"]))))
    return k.select(*by, "week", "oos_rate", "oos_rate_4w_avg", "lost_sales_gmv", "wape_non_oos",
                    "wape_non_oos_4w_avg", "units_non_oos",
                    F.coalesce(supply, F.lit(False)).alias("supply_alert"),
                    F.coalesce(model, F.lit(False)).alias("model_alert"))


def data_alert_counts(df: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """M6 data rule: invalid or extreme values, counted in one pass."""
    th = thresholds or DEFAULT_THRESHOLDS
    return df.agg(
        F.count_if((F.col("price") <= 0) | (F.col("stock") < 0)
                   | F.col("sku").isNull() | F.col("date").isNull()).alias("n_invalid"),
        F.count_if((F.col("price") > F.lit(float(th["data"]["max_price"])))
                   | (F.col("stock") > F.lit(int(th["data"]["max_stock"])))).alias("n_extreme"))


def loss_concentration(df: DataFrame, top: int = 10, share: float = 0.6, key: str = "sku") -> DataFrame:
    """M7: share of lost GMV held by the ``top`` SKUs (TakeOrdered, no full sort)."""
    per = df.groupBy(key).agg(F.sum("lost_sales_gmv").alias("lost"))
    top_sum = per.orderBy(F.col("lost").desc(), F.col(key)).limit(top).agg(
        F.sum("lost").alias("top_lost"), F.lit(None).cast("double").alias("total_lost"))
    total = per.agg(F.lit(None).cast("double").alias("top_lost"), F.sum("lost").alias("total_lost"))
    # two single-row results merged by union + aggregate
    j = top_sum.unionByName(total).agg(F.max("top_lost").alias("top_lost"),
                                       F.max("total_lost").alias("total_lost"))
    ratio = F.when(F.col("total_lost") > 0, F.col("top_lost") / F.col("total_lost")).otherwise(F.lit(0.0))
    return j.select(F.coalesce("top_lost", F.lit(0.0)).alias("top_lost_gmv"),
                    F.coalesce("total_lost", F.lit(0.0)).alias("total_lost_gmv"),
                    ratio.alias("top_share"), (ratio > share).alias("is_concentrated"))
