"""M8: governance run = coerce -> validate -> plan -> losses -> metrics -> alerts
-> weekly summary, returned as four tables (and optionally written)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwise.operators import governance as gov
from tillwise.sources import files


def governance_run(sku_day: DataFrame, thresholds: dict | None = None,
                   validate: bool = False, outdir: str | None = None) -> dict[str, DataFrame]:
    """Return ``daily``, ``metrics``, ``alerts`` and ``weekly`` DataFrames.

    The daily frame is one projection over the input; metrics and alerts are
    single aggregations over it, the weekly summary one grouped aggregation.
    ``validate=True`` runs the one-pass rule check (an action) first.
    """
    df = gov.coerce_types(sku_day)
    if validate:
        gov.validate_input(df)
    daily = gov.enrich(df)
    out = {
        "daily": daily,
        "metrics": gov.quality_metrics(daily),
        "alerts": gov.alerts(daily, thresholds),
        "weekly": gov.weekly_summary_demo(daily),
    }
    if outdir:
        files.write_tables({"governance_daily": out["daily"], "metrics_summary": out["metrics"],
                            "alerts": out["alerts"], "management_weekly_summary": out["weekly"]},
                           outdir, fmt="csv")
    return out
