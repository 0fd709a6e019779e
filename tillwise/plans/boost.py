"""Weekly boosting features = D1 -> E1 -> lag stats -> D2 -> global
stats -> C4 (left join on Monday), ordered by product and week.

The lagged product table feeds both branches; Spark reuses the identical
exchange (ReuseExchange) instead of recomputing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwise.operators import timeseries as ts

LAGS = 6


def product_lag_table(sales: DataFrame) -> DataFrame:
    """D1 + E1 over the raw sales rows."""
    return ts.week_lags(ts.weekly_product_sales(sales), lags=LAGS)


def boost_features(sales: DataFrame, order: bool = True) -> DataFrame:
    lagged = product_lag_table(sales)
    pf = ts.lag_stats(lagged, "y_lag_", "y_")
    gl = ts.global_week_sums(lagged, LAGS)
    gf = ts.lag_stats(gl, "y_all_lag_", "y_all_")
    out = ts.join_left_week(pf, gf)
    cols = (["product_name", "monday", "max_price", "y"] + [f"y_lag_{k}" for k in range(1, LAGS + 1)]
            + [f"y_{s}_{k}" for k in (3, 6) for s in ("avg", "max", "min")]
            + [f"y_all_lag_{k}" for k in range(1, LAGS + 1)]
            + [f"y_all_{s}_{k}" for k in (3, 6) for s in ("avg", "max", "min")])
    out = out.select(*cols)
    return out.orderBy("product_name", "monday") if order else out
