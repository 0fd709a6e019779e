"""Registered restocking, delivery, inventory-KPI and stock-service queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import inventory as inv
from tillwise.operators import timeseries as ts
from tillwise.operators.experiments import bootstrap_mean_ci
from tillwise.sources.fixtures import fx_delivery, fx_forecast_pairs, fx_inventory, fx_predictions, fx_restock

WEEKS = 2
BUDGET = 1_000_000


def _r2(x: str) -> str:
    """DuckDB twin of Spark ``bround(x, 2)`` (half-even on the decimal text)."""
    return f"cast(round_even(try_cast(cast(cast({x} as double) as varchar) as decimal(38, 20)), 2) as double)"


SCORES_SQL = f"""
sc as (select sku_id, percentile, greatest(demand - current_stock, 0) as demand_to_buy, price, cost, storage_time
       from fx_restock where weeks = {WEEKS}),
scores as (select sku_id, percentile, demand_to_buy, price, cost,
                  (price - cost) * demand_to_buy as tot_profit, price * demand_to_buy as tot_revenue,
                  cost * demand_to_buy as tot_cost, log10(cast(storage_time as double)) as storage_score,
                  1 - percentile / cast(100 as double) as oos_risk,
                  ((price - cost) / cost) * (1 - percentile / cast(100 as double))
                    * log10(cast(storage_time as double)) as profit_score,
                  (price / cost) * demand_to_buy * (1 - percentile / cast(100 as double))
                    * log10(cast(storage_time as double)) as revenue_score
           from sc where demand_to_buy > 0)"""
SCORE_DOUBLES = ("price", "cost", "tot_profit", "tot_revenue", "tot_cost", "storage_score", "oos_risk",
                 "profit_score", "revenue_score")


def _greedy_sql(goal: str) -> str:
    return f"""with recursive {SCORES_SQL},
fc as (select * from scores
       qualify row_number() over (partition by sku_id order by {goal}_score desc, percentile) = 1),
od as materialized (select *, row_number() over (order by {goal}_score desc, sku_id) as rn from fc),
rec as (
  select 0 as rn, cast({BUDGET} as double) as rem, cast(null as bigint) as sku_id, cast(null as integer) as percentile,
         cast(null as double) as price, cast(null as double) as cost, cast(0 as double) as qty
  union all
  select o.rn,
         r.rem - case when floor(r.rem / o.cost) > 0 then least(o.demand_to_buy, floor(r.rem / o.cost)) else 0 end
                 * o.cost,
         o.sku_id, o.percentile, o.price, o.cost,
         case when floor(r.rem / o.cost) > 0 then least(o.demand_to_buy, floor(r.rem / o.cost)) else 0 end
  from rec r join od o on o.rn = r.rn + 1 where r.rem > 0)
select sku_id, percentile, price, cost, qty as allocated_qty, qty * cost as allocated_budget,
       qty * (price - cost) as expected_profit, qty * price as expected_revenue
from rec where rn > 0 and qty > 0 order by allocated_budget desc, sku_id"""


@query("restock_scores", sql=f"with {SCORES_SQL} select * from scores order by profit_score desc, sku_id",
       doubles=SCORE_DOUBLES, longs=("percentile", "demand_to_buy"))
def q_restock_scores(spark, sf_dir):
    return inv.restock_scores(fx_restock(spark, sf_dir), WEEKS).orderBy(F.col("profit_score").desc(), "sku_id")


@query("restock_greedy", sql=_greedy_sql("profit"),
       doubles=("price", "cost", "allocated_qty", "allocated_budget", "expected_profit", "expected_revenue"),
       longs=("percentile",))
def q_restock_greedy(spark, sf_dir):
    return inv.restock_greedy(inv.restock_scores(fx_restock(spark, sf_dir), WEEKS), BUDGET, "profit")


@query("restock_greedy_revenue", sql=_greedy_sql("revenue"),
       doubles=("price", "cost", "allocated_qty", "allocated_budget", "expected_profit", "expected_revenue"),
       longs=("percentile",))
def q_restock_greedy_revenue(spark, sf_dir):
    return inv.restock_greedy(inv.restock_scores(fx_restock(spark, sf_dir), WEEKS), BUDGET, "revenue")


@query("restock_lp", note="integer plan near the relaxation's optimum: rows-only, checked by budget and bound")
def q_restock_lp(spark, sf_dir):
    alloc, _ = inv.restock_lagrangian(inv.restock_scores(fx_restock(spark, sf_dir), WEEKS), BUDGET, "profit")
    return alloc


# the relaxation again: hull vertices by pairwise slopes within a SKU, funded by falling slope
LP_SQL = f"""with {SCORES_SQL},
sv as (select sku_id, percentile, cost * demand_to_buy as c,
              cast(round_even(try_cast(cast(profit_score as varchar) as decimal(38, 20)), 4) as double) * demand_to_buy as v
       from scores where cost > 0),
pt as (select sku_id, c, max(v) as v from (select sku_id, c, v from sv where v > 0
                                           union all select distinct sku_id, 0.0, 0.0 from sv) group by all),
slopes as (select b.sku_id, b.c, b.v, min(case when a.c < b.c then (b.v - a.v) / (b.c - a.c) end) as rise,
                  coalesce(max(case when a.c > b.c then (a.v - b.v) / (a.c - b.c) end), 0) as next
           from pt a join pt b on a.sku_id = b.sku_id group by b.sku_id, b.c, b.v),
hull as (select sku_id, rise, c - coalesce(lag(c) over w, 0) as dc, v - coalesce(lag(v) over w, 0) as dv
         from slopes where c > 0 and rise > next and rise > 0 window w as (partition by sku_id order by c)),
filled as (select rise, dc, dv, coalesce(sum(dc) over (order by rise desc, sku_id rows between unbounded preceding
                                                       and 1 preceding), 0) as before from hull)
select round(sum(dv * least(1, ({BUDGET} - before) / dc)), 2) as relaxation,
       true as within_budget, true as below_dual_bound, true as near_dual_bound
from filled where before < {BUDGET}"""


@query("restock_lp_bounds", sql=LP_SQL, doubles=("relaxation",))
def q_restock_lp_bounds(spark, sf_dir):
    """The optimum of the relaxation; the plan keeps the budget, its value
    is below that optimum, and by no more than 1 % of it."""
    _, info = inv.restock_lagrangian(inv.restock_scores(fx_restock(spark, sf_dir), WEEKS), BUDGET, "profit")
    scale = max(abs(info["dual_bound"]), 1.0)
    return spark.createDataFrame([(round(info["dual_bound"], 2), info["spent"] <= BUDGET * (1 + 1e-9),
                                   info["value"] <= info["dual_bound"] + 1e-6 * scale, info["gap"] <= 0.01 * scale)],
                                 "relaxation double, within_budget boolean, below_dual_bound boolean, near_dual_bound boolean")


@query("validate_restock",
       sql="""with p as (select sku_id, first(price) as price, first(cost) as cost,
                               first(current_stock) as current_stock, first(storage_time) as storage_time,
                               count(distinct weeks) as nw, count(distinct (weeks, percentile)) as nwp,
                               count(distinct weeks) filter (where weeks in (1, 2, 3, 4)) as okw,
                               count(distinct (weeks, percentile)) filter (where weeks in (1, 2, 3, 4)
                                   and percentile in (5, 10, 25, 50, 75, 90, 95)) as okwp
                        from fx_restock group by sku_id)
              select 'price_le_0' as rule, count(*) filter (where price <= 0) as n_violations from p
              union all select 'cost_le_0', count(*) filter (where cost <= 0) from p
              union all select 'price_lt_cost', count(*) filter (where price < cost) from p
              union all select 'stock_lt_0', count(*) filter (where current_stock < 0) from p
              union all select 'storage_time_le_0', count(*) filter (where storage_time <= 0) from p
              union all select 'missing_weeks', count(*) filter (where okw < 4) from p
              union all select 'missing_percentiles', count(*) filter (where okwp < 28) from p""")
def q_validate_restock(spark, sf_dir):
    return inv.validate_restock(fx_restock(spark, sf_dir))


@query("inventory_kpis",
       sql=f"""with a as (select sum(price * quantity_sold) as rev, sum(cost * quantity_sold) as cogs,
                                 sum((inventory_start + inventory_end) / 2) as inv from fx_inventory),
               b as (select {_r2('rev')} as gmv, {_r2('rev - cogs')} as gross_margin,
                            case when rev = 0 then 0.0 else {_r2('(rev - cogs) / rev * 100')} end as gross_margin_pct,
                            {_r2('inv')} as avg_inventory, cogs from a),
               c as (select *, case when avg_inventory = 0 then 0.0 else {_r2('gross_margin / avg_inventory')} end
                               as gmroi,
                            case when avg_inventory = 0 then 0.0 else {_r2('cogs / avg_inventory')} end as turnover
                     from b)
               select gmv, gross_margin, gross_margin_pct, avg_inventory, gmroi, turnover,
                      case when turnover = 0 then 0.0 else {_r2('365.0 / turnover')} end as turnover_days from c""",
       doubles=("gmv", "gross_margin", "gross_margin_pct", "avg_inventory", "gmroi", "turnover", "turnover_days"))
def q_inventory_kpis(spark, sf_dir):
    return inv.inventory_kpis(fx_inventory(spark, sf_dir))


@query("bundle_delivery", note="exact per-product DP in a grouped map; checked by constraint properties")
def q_bundle_delivery(spark, sf_dir):
    return inv.bundle_delivery(fx_delivery(spark, sf_dir))


@query("bundle_delivery_totals",
       sql="""with recursive
              m as (select *, row_number() over (partition by product order by marketplace) as place from fx_delivery),
              p as (select product, max(stock) as stock, max(small) as small, max(middle) as middle, max(large) as large, count(*) as places
                    from m group by product),
              sums(product, units) as (select product, cast(0 as bigint) from p
                  union select s.product, s.units + x.size from sums s join p on p.product = s.product,
                        lateral (select unnest([p.small, p.middle, p.large]) as size) x where s.units + x.size <= p.stock),
              choice as (select m.product, m.place, sums.units from m join sums on sums.product = m.product
                         where sums.units between m.min_demand and m.max_demand),
              plans(product, place, total) as (select product, cast(0 as bigint), cast(0 as bigint) from p
                  union select t.product, t.place + 1, t.total + c.units from plans t join p on p.product = t.product
                        join choice c on c.product = t.product and c.place = t.place + 1 where t.total + c.units <= p.stock)
              select p.product, coalesce(max(t.total), 0) as units, case when max(t.total) is null then 'infeasible' else 'optimal' end as status
              from p left join plans t on t.product = p.product and t.place = p.places group by p.product""",
       longs=("units",))
def q_bundle_delivery_totals(spark, sf_dir):
    """The maximised units of each product (the split between marketplaces is not unique)."""
    return inv.bundle_delivery(fx_delivery(spark, sf_dir)).groupBy("product").agg(
        F.sum("units").alias("units"), F.first("status").alias("status"))


def _requests(spark, sf_dir):
    return fx_predictions(spark, sf_dir).select("sku_id", "stock")


def _preds(spark, sf_dir):
    return fx_predictions(spark, sf_dir).drop("stock")


@query("lookup_join", sql="select sku_id, stock, pred_7d_q50 as forecast from fx_predictions",
       doubles=("forecast",))
def q_lookup_join(spark, sf_dir):
    return inv.forecast_for(_requests(spark, sf_dir), _preds(spark, sf_dir), 7, 50)


@query("order_quantity",
       sql="""select sku_id, stock, pred_7d_q90 as forecast,
                     cast(trunc(greatest(0.0, pred_7d_q90 - stock)) as bigint) as quantity from fx_predictions""",
       doubles=("forecast",))
def q_order_quantity(spark, sf_dir):
    return inv.order_quantity(_requests(spark, sf_dir), _preds(spark, sf_dir), 7, 90)


@query("order_quantity_ceil",
       sql="""select sku_id, stock, pred_7d_q90 as forecast,
                     cast(ceil(greatest(0.0, pred_7d_q90 - stock)) as bigint) as quantity from fx_predictions""",
       doubles=("forecast",))
def q_order_quantity_ceil(spark, sf_dir):
    return inv.order_quantity(_requests(spark, sf_dir), _preds(spark, sf_dir), 7, 90, rounding="ceil")


@query("stock_forecast",
       sql="""select sku_id, stock, pred_7d_q50 as forecast, greatest(0.0, stock - pred_7d_q50) as stock_forecast
              from fx_predictions""",
       doubles=("forecast", "stock_forecast"))
def q_stock_forecast(spark, sf_dir):
    return inv.stock_forecast(_requests(spark, sf_dir), _preds(spark, sf_dir), 7, 50)


@query("low_stock_list",
       sql="select sku_id, stock, pred_7d_q10 as forecast from fx_predictions where stock < pred_7d_q10",
       doubles=("forecast",))
def q_low_stock_list(spark, sf_dir):
    return inv.low_stock_list(_requests(spark, sf_dir), _preds(spark, sf_dir), 7, 10)


@query("missed_profit_ci",
       sql="""with d as (select cast(day as date) as day, greatest(p - y, 0) * price as missed_profits,
                               y * price as revenue from fx_forecast_pairs),
                   wk0 as (select day + cast((7 - dayofweek(day)) % 7 as integer) as day,
                                  sum(revenue) as revenue, sum(missed_profits) as missed_profits from d group by 1),
                   b as (select min(day) as lo, max(day) as hi from wk0),
                   weeks as (select cast(g as date) as day
                             from b, unnest(generate_series(b.lo, b.hi, interval 7 day)) as t(g)),
                   wk as (select w.day, coalesce(wk0.revenue, 0.0) as revenue,
                                 coalesce(wk0.missed_profits, 0.0) as missed_profits
                          from weeks w left join wk0 on wk0.day = w.day),
                   idx as (select row_number() over (order by day) - 1 as i, missed_profits, revenue from wk),
                   n as (select count(*) as n from wk),
                   draws as (select r.b, s.j from range(1000) as r(b), n, unnest(range(n.n)) as s(j)),
                   dr as (select draws.b,
                                 floor(cast(cast('0x' || substr(md5(concat_ws('-', '42', cast(draws.b as varchar),
                                       cast(draws.j as varchar))), 1, 8) as bigint) as double)
                                       / cast(4294967296 as double) * n.n) as i
                          from draws, n),
                   per as (select dr.b, avg(idx.missed_profits) as m, avg(idx.revenue) as r
                           from dr join idx on idx.i = dr.i group by dr.b)
              select (select avg(missed_profits) from wk) as avg_missed_profits,
                     quantile_cont(m, 0.025) as abs_ci_lower, quantile_cont(m, 0.975) as abs_ci_upper,
                     (select avg(missed_profits) / avg(revenue) from wk) as relative_missed_profits,
                     quantile_cont(m / r, 0.025) as rel_ci_lower, quantile_cont(m / r, 0.975) as rel_ci_upper
              from per""",
       doubles=("avg_missed_profits", "abs_ci_lower", "abs_ci_upper", "relative_missed_profits",
                "rel_ci_lower", "rel_ci_upper"))
def q_missed_profit_ci(spark, sf_dir):
    weekly = ts.week_missed_profits(fx_forecast_pairs(spark, sf_dir), sales="y", forecast="p")
    return bootstrap_mean_ci(weekly, "missed_profits", "revenue", n_boot=1000, seed=42)
