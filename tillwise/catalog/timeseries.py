"""Registered panel / time-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import metrics as mt
from tillwise.operators import timeseries as ts
from tillwise.plans import demand
from tillwise.plans.boost import boost_features, product_lag_table
from tillwise.sources.fixtures import (fx_demand_orders, fx_demand_status, fx_forecast_pairs, fx_logs,
                                       fx_sales_train)

# ------------------------------------------------------------ DuckDB pieces
PANEL_SQL = """
sales as (select cast(ts as date) as day, sku_id, sku, price, sum(qty) as qty
          from fx_demand_orders group by 1, 2, 3, 4),
bounds as (select min(day) as lo, max(day) as hi from sales),
ids as (select distinct sku_id from sales),
grid as (select ids.sku_id, cast(g as date) as day
         from ids, bounds, unnest(generate_series(bounds.lo, bounds.hi, interval 1 day)) as t(g)),
dims as (select distinct sku_id, sku as sku_d, price as price_d from fx_demand_orders),
panel as (select g.day, g.sku_id, coalesce(s.sku, d.sku_d) as sku, coalesce(s.price, d.price_d) as price,
                 cast(coalesce(s.qty, 0) as bigint) as qty
          from grid g left join sales s on s.day = g.day and s.sku_id = g.sku_id
          left join dims d on d.sku_id = g.sku_id)"""


def _feature_sql(min_periods: str = "one") -> str:
    parts = []
    for name, (col, n, agg, q) in ts.DEFAULT_FEATURES.items():
        frame = f"(partition by sku_id order by day rows between {n - 1} preceding and current row)"
        if agg == "avg":
            e = f"avg(cast({col} as double)) over {frame}"
        else:
            e = f"quantile_cont(cast({col} as double), {q / 100.0}) over {frame}"
        if min_periods == "window":
            e = f"case when count({col}) over {frame} = {n} then {e} end"
        parts.append(f"{e} as {name}")
    return ",\n ".join(parts)


def _target_sql(variant: str) -> str:
    parts = []
    for name, (col, n) in ts.DEFAULT_TARGETS.items():
        base = "partition by sku_id order by day"
        if variant == "next":
            w = f"({base} rows between 1 following and {n} following)"
            e = f"case when count({col}) over {w} = {n} then sum({col}) over {w} end"
        else:
            g = f"({base} rows between {n - 1} preceding and 1 following)"
            w = f"({base} rows between {n - 2} preceding and 1 following)"
            e = f"case when count({col}) over {g} = {n + 1} then sum({col}) over {w} end"
        parts.append(f"cast({e} as double) as {name}")
    return ",\n ".join(parts)


FEAT_SQL = PANEL_SQL + f""",
feat as (select *, {_feature_sql()}, {_target_sql('as_coded')} from panel)"""

AVG_COLS = [k for k, v in ts.DEFAULT_FEATURES.items() if v[2] == "avg"]
Q_COLS = [k for k, v in ts.DEFAULT_FEATURES.items() if v[2] == "quantile"]
TGT_COLS = list(ts.DEFAULT_TARGETS)


def _panel(spark, sf_dir):
    return ts.extract_sales(fx_demand_orders(spark, sf_dir))


@query("daily_qty",
       sql="select cast(ts as date) as day, sku_id, sum(qty) as qty from fx_demand_orders group by 1, 2",
       strings=("day",), longs=("qty",))
def q_daily_qty(spark, sf_dir):
    return ts.daily_qty(fx_demand_orders(spark, sf_dir))


@query("dense_calendar", sql=f"with {PANEL_SQL} select sku_id, day from grid", strings=("day",))
def q_dense_calendar(spark, sf_dir):
    o = fx_demand_orders(spark, sf_dir)
    lo, hi = ts.day_bounds(o.select(F.to_date("ts").alias("day")))
    return ts.dense_calendar(o.select("sku_id").distinct(), lo, hi)


@query("extract_sales", sql=f"with {PANEL_SQL} select * from panel", doubles=("price",), strings=("day",))
def q_extract_sales(spark, sf_dir):
    return _panel(spark, sf_dir)


@query("semi_join_status",
       sql="""select order_id, ts, sku_id, qty from fx_demand_orders
              where order_id in (select order_id from fx_demand_status
                                 where status not in ('Return', 'Lost', 'Canceled'))""",
       strings=("ts",))
def q_semi_join_status(spark, sf_dir):
    o = fx_demand_orders(spark, sf_dir).select("order_id", "ts", "sku_id", "qty")
    return ts.valid_orders(o, fx_demand_status(spark, sf_dir))


@query("demand_grid",
       sql="""with d as (select distinct cast(ts as date) as day from fx_demand_orders),
                   s as (select distinct sku_id, sku, price from fx_demand_orders),
                   sales as (select cast(o.ts as date) as day, o.sku_id, sum(o.qty) as total_qty
                             from fx_demand_orders o
                             where o.order_id in (select order_id from fx_demand_status
                                                  where status not in ('Return', 'Lost', 'Canceled'))
                             group by 1, 2)
              select strftime(d.day, '%Y-%m-%d') as day, s.sku_id, s.sku, s.price,
                     coalesce(sales.total_qty, 0) as qty
              from d cross join s left join sales on d.day = sales.day and s.sku_id = sales.sku_id
              order by s.sku_id, day""",
       doubles=("price",), longs=("qty",))
def q_demand_grid(spark, sf_dir):
    return ts.demand_grid(fx_demand_orders(spark, sf_dir), fx_demand_status(spark, sf_dir))


@query("roll_mean",
       sql=f"with {FEAT_SQL} select day, sku_id, qty, {', '.join(AVG_COLS)} from feat",
       doubles=tuple(AVG_COLS), strings=("day",))
def q_roll_mean(spark, sf_dir):
    f = {k: v for k, v in ts.DEFAULT_FEATURES.items() if v[2] == "avg"}
    return ts.add_rolling_features(_panel(spark, sf_dir), f).select("day", "sku_id", "qty", *AVG_COLS)


@query("roll_mean_full",
       sql=f"with {PANEL_SQL} select day, sku_id, qty, {_feature_sql('window')} from panel",
       doubles=tuple(ts.DEFAULT_FEATURES), strings=("day",))
def q_roll_mean_full(spark, sf_dir):
    """E3/E4 with ``min_periods = window`` (NULL until the window is full)."""
    return ts.add_rolling_features(_panel(spark, sf_dir), min_periods="window").select(
        "day", "sku_id", "qty", *ts.DEFAULT_FEATURES)


@query("roll_quantile",
       sql=f"with {FEAT_SQL} select day, sku_id, qty, {', '.join(Q_COLS)} from feat",
       doubles=tuple(Q_COLS), strings=("day",))
def q_roll_quantile(spark, sf_dir):
    f = {k: v for k, v in ts.DEFAULT_FEATURES.items() if v[2] == "quantile"}
    return ts.add_rolling_features(_panel(spark, sf_dir), f).select("day", "sku_id", "qty", *Q_COLS)


@query("fwd_target",
       sql=f"with {PANEL_SQL} select day, sku_id, qty, {_target_sql('next')} from panel",
       doubles=tuple(TGT_COLS), strings=("day",))
def q_fwd_target(spark, sf_dir):
    return ts.add_targets(_panel(spark, sf_dir), variant="next").select("day", "sku_id", "qty", *TGT_COLS)


@query("fwd_target_as_coded",
       sql=f"with {PANEL_SQL} select day, sku_id, qty, {_target_sql('as_coded')} from panel",
       doubles=tuple(TGT_COLS), strings=("day",))
def q_fwd_target_as_coded(spark, sf_dir):
    return ts.add_targets(_panel(spark, sf_dir), variant="as_coded").select("day", "sku_id", "qty", *TGT_COLS)


@query("train_test_split",
       sql=f"""with {PANEL_SQL}
               select day, sku_id, qty,
                      case when day >= (select max(day) from panel) - 29 then 'test' else 'train' end as role
               from panel""",
       strings=("day",))
def q_train_test_split(spark, sf_dir):
    return ts.train_test_split(_panel(spark, sf_dir), 30).select("day", "sku_id", "qty", "role")


@query("last_day_rows",
       sql=f"with {PANEL_SQL} select * from panel where day = (select max(day) from panel)",
       doubles=("price",), strings=("day",))
def q_last_day_rows(spark, sf_dir):
    return ts.last_day_rows(_panel(spark, sf_dir))


@query("week_missed_profits",
       sql="""with d as (select cast(day as date) as day, greatest(p - y, 0) * price as missed_profits,
                               y * price as revenue from fx_forecast_pairs),
                   wk as (select day + cast((7 - dayofweek(day)) % 7 as integer) as day,
                                 sum(revenue) as revenue, sum(missed_profits) as missed_profits
                          from d group by 1),
                   b as (select min(day) as lo, max(day) as hi from wk),
                   weeks as (select cast(g as date) as day
                             from b, unnest(generate_series(b.lo, b.hi, interval 7 day)) as t(g))
              select w.day, coalesce(wk.revenue, 0.0) as revenue, coalesce(wk.missed_profits, 0.0) as missed_profits
              from weeks w left join wk on wk.day = w.day""",
       doubles=("revenue", "missed_profits"), strings=("day",))
def q_week_missed_profits(spark, sf_dir):
    return ts.week_missed_profits(fx_forecast_pairs(spark, sf_dir), sales="y", forecast="p")


@query("gaps_islands",
       sql="""with numbered as (select log_id, row_number() over (order by log_id) as place from fx_logs),
                   paired as (select n.log_id, p.log_id as prev_log_id, p.log_id is distinct from n.log_id - 1 as opens
                              from numbered n left join numbered p on p.place = n.place - 1)
              select log_id, prev_log_id, count(*) filter (where opens) over (order by log_id) as grp from paired""",
       longs=("grp",))
def q_gaps_islands(spark, sf_dir):
    return ts.gaps_islands(fx_logs(spark, sf_dir))


# ------------------------------------------------------------------ BOOST
LAGS, SPANS = 6, (3, 6)


def _stats_sql(source: str, name: str) -> str:
    """Statistics of the first k entries of a list of lags, newest first."""
    parts = []
    for k in SPANS:
        part = f"list_slice({source}, 1, {k})"
        parts += [f"list_sum({part}) / {k}.0 as {name}avg_{k}", f"list_max({part}) as {name}max_{k}",
                  f"list_min({part}) as {name}min_{k}"]
    return ", ".join(parts)


def _lags_sql(source: str, name: str) -> str:
    return ", ".join(f"cast({source}[{k}] as bigint) as {name}{k}" for k in range(1, LAGS + 1))


# the lags of a week are the list of the weeks before it, newest first, filled up with zeros
WEEKLY_SQL = f"""
pw as (select product_name, cast(date_trunc('week', dt) as date) as monday, max(price) as max_price,
              count(*) as y from fx_sales_train group by all),
hist as (select *, list_concat(list_reverse(list(y) over (partition by product_name order by monday
                                                          rows between {LAGS} preceding and 1 preceding)),
                               list_resize([]::bigint[], {LAGS}, 0)) as past from pw),
pl as (select product_name, monday, max_price, y, {_lags_sql("past", "y_lag_")} from hist),
pf as (select product_name, monday, max_price, y, {_lags_sql("past", "y_lag_")}, {_stats_sql("past", "y_")} from hist),
every as (select monday, [{", ".join(f"sum(past[{k}])" for k in range(1, LAGS + 1))}] as past from hist group by monday),
gl as (select monday, {_lags_sql("past", "y_all_lag_")} from every),
gf as (select monday, {_lags_sql("past", "y_all_lag_")}, {_stats_sql("past", "y_all_")} from every)"""
LAG_COLS = [f"y_lag_{k}" for k in range(1, 7)]
STAT_DOUBLES = ("y_avg_3", "y_avg_6")


@query("weekly_product_sales", sql=f"with {WEEKLY_SQL} select * from pw",
       doubles=("max_price",), strings=("monday",))
def q_weekly_product_sales(spark, sf_dir):
    return ts.weekly_product_sales(fx_sales_train(spark, sf_dir))


@query("week_lags", sql=f"with {WEEKLY_SQL} select product_name, monday, y, {', '.join(LAG_COLS)} from pl",
       strings=("monday",))
def q_week_lags(spark, sf_dir):
    return ts.week_lags(ts.weekly_product_sales(fx_sales_train(spark, sf_dir))).select(
        "product_name", "monday", "y", *LAG_COLS)


@query("global_week_sums", sql=f"with {WEEKLY_SQL} select * from gl", strings=("monday",))
def q_global_week_sums(spark, sf_dir):
    return ts.global_week_sums(product_lag_table(fx_sales_train(spark, sf_dir)))


BOOST_DOUBLES = ("max_price", "y_avg_3", "y_avg_6", "y_all_avg_3", "y_all_avg_6")
BOOST_LONGS = ("y_all_max_3", "y_all_min_3", "y_all_max_6", "y_all_min_6")


@query("join_left_week",
       sql=f"""with {WEEKLY_SQL} select pf.product_name, pf.monday, pf.y, gf.y_all_lag_1, gf.y_all_avg_3
               from pf left join gf on pf.monday = gf.monday""",
       doubles=("y_all_avg_3",), strings=("monday",))
def q_join_left_week(spark, sf_dir):
    b = boost_features(fx_sales_train(spark, sf_dir), order=False)
    return b.select("product_name", "monday", "y", "y_all_lag_1", "y_all_avg_3")


@query("boost_features",
       sql=f"""with {WEEKLY_SQL} select pf.*, gf.* exclude (monday)
               from pf left join gf on pf.monday = gf.monday order by pf.product_name, pf.monday""",
       doubles=BOOST_DOUBLES, strings=("monday",), longs=BOOST_LONGS)
def q_boost_features(spark, sf_dir):
    return boost_features(fx_sales_train(spark, sf_dir))


# ------------------------------------------------------- K8 / K9 / D13
def _eval_sql(select: str) -> str:
    preds = ", ".join(f"qty_{h}d_q{q} * {float(h)} as pred_{h}d_q{q}"
                      for h in demand.HORIZONS for q in demand.QUANTILES)
    need = " and ".join(f"{c} is not null" for c in ["price", "qty", *ts.DEFAULT_FEATURES, *TGT_COLS])
    losses = " union all ".join(
        f"select {q / 100} as quantile, {h} as horizon, "
        f"avg({q / 100} * greatest(next_{h}d - pred_{h}d_q{q}, 0.0) "
        f"+ (1 - {q / 100}) * greatest(pred_{h}d_q{q} - next_{h}d, 0.0)) as avg_quantile_loss from pred"
        for q in demand.QUANTILES for h in demand.HORIZONS)
    return f"""with {FEAT_SQL},
      test as (select * from feat where day >= (select max(day) from feat) - 29 and {need}),
      pred as (select *, {preds} from test),
      losses as ({losses})
      {select}"""


@query("evaluate_quantiles", sql=_eval_sql("select * from losses"),
       doubles=("quantile", "avg_quantile_loss"), longs=("horizon",))
def q_evaluate_quantiles(spark, sf_dir):
    return demand.baseline_evaluation(fx_demand_orders(spark, sf_dir))


@query("losses_ok",
       sql=_eval_sql("select coalesce(bool_and(not (avg_quantile_loss is null or isnan(avg_quantile_loss) "
                     "or avg_quantile_loss < 0)), true) as losses_ok from losses"))
def q_losses_ok(spark, sf_dir):
    return mt.losses_ok(demand.baseline_evaluation(fx_demand_orders(spark, sf_dir)))


@query("quality_means",
       sql=_eval_sql("select (" + " + ".join(f"avg(pred_{h}d_q10)" for h in demand.HORIZONS) + ") / 3.0 as avg_q10, ("
                     + " + ".join(f"avg(pred_{h}d_q90)" for h in demand.HORIZONS) + ") / 3.0 as avg_q90 from pred"),
       doubles=("avg_q10", "avg_q90"))
def q_quality_means(spark, sf_dir):
    test = demand.test_window_rows(fx_demand_orders(spark, sf_dir), 30)
    return demand.quality_means(demand.quantile_baseline(test))
