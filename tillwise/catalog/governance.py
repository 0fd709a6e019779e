"""Registered governance queries (fixture ``fx_sku_day``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import governance as gov
from tillwise.plans.governance import governance_run
from tillwise.sources.fixtures import fx_sku_day

# DuckDB text of the enriched daily table (M2 + M3 + actual GMV)
GOV_DAILY = """
gov_units as (
  select *, greatest(case when price > 0 then cast(floor(forecast_gmv / price) as bigint) else 0 end, 0)
            as forecast_units
  from fx_sku_day),
gov_feas as (
  select *, greatest(least(forecast_units, stock), 0) as feasible_units,
         forecast_units > stock as is_stock_constrained,
         greatest(forecast_units - stock, 0) as lost_sales_units
  from gov_units),
gov_daily as (
  select date, sku, category, price, stock, forecast_gmv, actual_units, forecast_units, feasible_units,
         feasible_units * price as feasible_gmv, is_stock_constrained, lost_sales_units,
         lost_sales_units * price as lost_sales_gmv, actual_units * price as actual_gmv
  from gov_feas)"""

DAILY_DOUBLES = ("price", "forecast_gmv", "feasible_gmv", "lost_sales_gmv", "actual_gmv")


def _daily(spark, sf_dir):
    return gov.enrich(fx_sku_day(spark, sf_dir))


@query("extract_sku_day",
       sql="""select date, sku, category, price, stock, forecast_gmv, actual_units from fx_sku_day
              where date between date '1996-01-01' and date '1998-12-31'""",
       doubles=("price", "forecast_gmv"), strings=("date",))
def q_extract_sku_day(spark, sf_dir):
    d = fx_sku_day(spark, sf_dir)
    return d.select("date", "sku", "category", "price", "stock", "forecast_gmv", "actual_units").where(
        F.col("date").between(F.lit("1996-01-01").cast("date"), F.lit("1998-12-31").cast("date")))


@query("coerce_types_gov",
       sql="""select date, sku, category, price, stock, forecast_gmv, coalesce(actual_units, 0) as actual_units
              from fx_sku_day""",
       doubles=("price", "forecast_gmv"), strings=("date",))
def q_coerce_types_gov(spark, sf_dir):
    return gov.coerce_types(fx_sku_day(spark, sf_dir))


@query("validate_gov",
       sql="""select count(*) filter (where price <= 0) as n_price_le_0,
                     count(*) filter (where stock < 0) as n_stock_lt_0,
                     count(*) filter (where date is null or sku is null) as n_null_key,
                     count(*) as n_rows
              from fx_sku_day""")
def q_validate_gov(spark, sf_dir):
    return gov.validation_counts(fx_sku_day(spark, sf_dir))


@query("feasible_plan",
       sql=f"""with {GOV_DAILY}
               select date, sku, category, price, stock, forecast_gmv, actual_units, forecast_units,
                      feasible_units, feasible_gmv, is_stock_constrained from gov_daily""",
       doubles=("price", "forecast_gmv", "feasible_gmv"), strings=("date",))
def q_feasible_plan(spark, sf_dir):
    return gov.feasible_plan(fx_sku_day(spark, sf_dir))


@query("lost_sales",
       sql=f"""with {GOV_DAILY}
               select date, sku, forecast_units, stock, price, lost_sales_units, lost_sales_gmv from gov_daily""",
       doubles=("price", "lost_sales_gmv"), strings=("date",))
def q_lost_sales(spark, sf_dir):
    return gov.lost_sales(gov.feasible_plan(fx_sku_day(spark, sf_dir))).select(
        "date", "sku", "forecast_units", "stock", "price", "lost_sales_units", "lost_sales_gmv")


@query("feasible_plan_flat",
       sql="""with u as (
                select date, sku, forecast_gmv as gmv, price, stock,
                       greatest(case when price > 0 then cast(floor(forecast_gmv / price) as bigint) else 0 end, 0)
                         as units_forecast
                from fx_sku_day),
              f as (select *, least(units_forecast, stock) as units_feasible from u)
              select date, sku, gmv, price, stock, units_forecast, units_feasible,
                     units_feasible * price as gmv_feasible,
                     greatest(units_forecast - units_feasible, 0) as lost_sales_units,
                     greatest(units_forecast - units_feasible, 0) * price as lost_sales_gmv
              from f""",
       doubles=("gmv", "price", "gmv_feasible", "lost_sales_gmv"), strings=("date",))
def q_feasible_plan_flat(spark, sf_dir):
    d = fx_sku_day(spark, sf_dir).select("date", "sku", F.col("forecast_gmv").alias("gmv"), "price", "stock")
    return gov.feasible_plan_flat(d)


@query("governance_run",
       sql=f"with {GOV_DAILY} select * from gov_daily",
       doubles=DAILY_DOUBLES, strings=("date",))
def q_governance_run(spark, sf_dir):
    return governance_run(fx_sku_day(spark, sf_dir))["daily"]


GOV_QUALITY_SQL = """
  case when sum(abs(actual_units)) = 0 then 0.0
       else sum(abs(actual_units - forecast_units)) / sum(abs(actual_units)) end as wape_raw,
  case when sum(actual_units) = 0 then 0.0
       else sum(forecast_units - actual_units) / sum(actual_units) end as bias_raw,
  case when coalesce(sum(abs(actual_units)) filter (where not is_stock_constrained), 0) = 0 then 0.0
       else sum(abs(actual_units - forecast_units)) filter (where not is_stock_constrained)
            / sum(abs(actual_units)) filter (where not is_stock_constrained) end as wape_non_oos,
  case when coalesce(sum(actual_units) filter (where not is_stock_constrained), 0) = 0 then 0.0
       else sum(forecast_units - actual_units) filter (where not is_stock_constrained)
            / sum(actual_units) filter (where not is_stock_constrained) end as bias_non_oos"""


@query("gov_quality",
       sql=f"with {GOV_DAILY} select {GOV_QUALITY_SQL} from gov_daily",
       doubles=("wape_raw", "bias_raw", "wape_non_oos", "bias_non_oos"))
def q_gov_quality(spark, sf_dir):
    return gov.quality_metrics(_daily(spark, sf_dir))


@query("gov_quality_by_category",
       sql=f"with {GOV_DAILY} select category, {GOV_QUALITY_SQL} from gov_daily group by category",
       doubles=("wape_raw", "bias_raw", "wape_non_oos", "bias_non_oos"))
def q_gov_quality_by_category(spark, sf_dir):
    return gov.quality_metrics(_daily(spark, sf_dir), by=["category"])


@query("gov_alerts",
       sql=f"""with {GOV_DAILY},
               m as (select coalesce(sum(lost_sales_gmv), 0.0) as lost, bool_or(price > 10000000.0) as bad_price,
                            {GOV_QUALITY_SQL} from gov_daily)
               select 'CRIT' as level, 'SUPPLY' as type,
                      'High lost sales due to OOS: ' || format('{{:,.0f}}', lost) || ' GMV (period total).' as message,
                      'Supply/Logistics' as owner,
                      'Review top SKUs by lost_sales_gmv; expedite inbound / redistribute / adjust safety stock.' as action
               from m where lost >= 1000000.0
               union all
               select 'WARN', 'MODEL', 'Non-OOS WAPE is elevated: ' || format('{{:.3f}}', wape_non_oos) || '.',
                      'Forecast Owner (Planning/DS)',
                      'Check promo factors, seasonality, price elasticity; review recent data changes.'
               from m where wape_non_oos >= 0.05 + wape_raw
               union all
               select 'WARN', 'DATA', 'Extreme price values detected (above max_price).', 'DWH/Source Systems',
                      'Validate price feed; check currency/scale issues; correct upstream mapping.'
               from m where coalesce(bad_price, false)""")
def q_gov_alerts(spark, sf_dir):
    return gov.alerts(_daily(spark, sf_dir))


@query("gov_alerts_low_threshold",
       sql=f"""with {GOV_DAILY},
               m as (select coalesce(sum(lost_sales_gmv), 0.0) as lost, bool_or(price > 30.0) as bad_price,
                            {GOV_QUALITY_SQL} from gov_daily)
               select 'CRIT' as level, 'SUPPLY' as type,
                      'High lost sales due to OOS: ' || format('{{:,.0f}}', lost) || ' GMV (period total).' as message,
                      'Supply/Logistics' as owner,
                      'Review top SKUs by lost_sales_gmv; expedite inbound / redistribute / adjust safety stock.' as action
               from m where lost >= 1000.0
               union all
               select 'WARN', 'MODEL', 'Non-OOS WAPE is elevated: ' || format('{{:.3f}}', wape_non_oos) || '.',
                      'Forecast Owner (Planning/DS)',
                      'Check promo factors, seasonality, price elasticity; review recent data changes.'
               from m where wape_non_oos >= -0.5 + wape_raw
               union all
               select 'WARN', 'DATA', 'Extreme price values detected (above max_price).', 'DWH/Source Systems',
                      'Validate price feed; check currency/scale issues; correct upstream mapping.'
               from m where coalesce(bad_price, false)""",
       note="M5 with thresholds low enough that every rule fires on the test tables")
def q_gov_alerts_low(spark, sf_dir):
    th = {"supply": {"lost_sales_gmv_week_min": 1000, "oos_rate_multiplier": 1.3},
          "model": {"wape_delta": -0.5, "min_units_for_evaluation": 0},
          "data": {"max_price": 30, "max_stock": 1000000}}
    return gov.alerts(_daily(spark, sf_dir), th)


@query("gov_weekly_sql",
       sql=f"""with {GOV_DAILY}
               select date - cast(dayofweek(date) as integer) as week, category,
                      sum(lost_sales_gmv) as lost_sales_gmv,
                      avg(cast(is_stock_constrained as integer)) as oos_rate,
                      sum(actual_units) as actual_units
               from gov_daily group by 1, 2 order by week desc, lost_sales_gmv desc""",
       doubles=("lost_sales_gmv", "oos_rate"), strings=("week",), longs=("actual_units",))
def q_gov_weekly_sql(spark, sf_dir):
    return gov.weekly_summary_sql(_daily(spark, sf_dir))


@query("gov_weekly_demo",
       sql=f"""with {GOV_DAILY}
               select strftime(cast(date_trunc('week', date) as date), '%Y-%m-%d') || '/' ||
                      strftime(cast(date_trunc('week', date) as date) + 6, '%Y-%m-%d') as week, category,
                      sum(lost_sales_gmv) as lost_sales_gmv,
                      avg(cast(is_stock_constrained as integer)) as oos_rate,
                      sum(feasible_gmv) as feasible_gmv, sum(forecast_gmv) as forecast_gmv
               from gov_daily group by 1, 2""",
       doubles=("lost_sales_gmv", "oos_rate", "feasible_gmv", "forecast_gmv"))
def q_gov_weekly_demo(spark, sf_dir):
    return gov.weekly_summary_demo(_daily(spark, sf_dir))


WEEKLY_KPI_SQL = f"""with {GOV_DAILY},
  wk as (
    select category, cast(date_trunc('week', date) as date) as week,
           avg(cast(is_stock_constrained as integer)) as oos_rate,
           sum(lost_sales_gmv) as lost_sales_gmv,
           case when coalesce(sum(abs(actual_units)) filter (where not is_stock_constrained), 0) = 0 then 0.0
                else sum(abs(actual_units - forecast_units)) filter (where not is_stock_constrained)
                     / sum(abs(actual_units)) filter (where not is_stock_constrained) end as wape_non_oos,
           sum(actual_units) filter (where not is_stock_constrained) as units_non_oos
    from gov_daily group by 1, 2),
  wk4 as (
    select *, avg(oos_rate) over w as oos_rate_4w_avg, avg(wape_non_oos) over w as wape_non_oos_4w_avg
    from wk window w as (partition by category order by week rows between 4 preceding and 1 preceding))"""


@query("rolling_4w_baseline",
       sql=WEEKLY_KPI_SQL + " select category, week, oos_rate, oos_rate_4w_avg, lost_sales_gmv from wk4",
       doubles=("oos_rate", "oos_rate_4w_avg", "lost_sales_gmv"), strings=("week",))
def q_rolling_4w_baseline(spark, sf_dir):
    k = gov.weekly_kpis(_daily(spark, sf_dir), ["category"])
    return gov.rolling_baseline(k, "oos_rate", ["category"], out="oos_rate_4w_avg").select(
        "category", "week", "oos_rate", "oos_rate_4w_avg", "lost_sales_gmv")


@query("gov_alerts_weekly",
       sql=WEEKLY_KPI_SQL + """
         select category, week, oos_rate, oos_rate_4w_avg, lost_sales_gmv, wape_non_oos, wape_non_oos_4w_avg,
                units_non_oos,
                coalesce(oos_rate > 1.3 * oos_rate_4w_avg and lost_sales_gmv > 1000000.0, false) as supply_alert,
                coalesce(wape_non_oos > wape_non_oos_4w_avg + 0.05 and units_non_oos > 5000, false) as model_alert
         from wk4""",
       doubles=("oos_rate", "oos_rate_4w_avg", "lost_sales_gmv", "wape_non_oos", "wape_non_oos_4w_avg"),
       strings=("week",), longs=("units_non_oos",))
def q_gov_alerts_weekly(spark, sf_dir):
    return gov.weekly_alerts(_daily(spark, sf_dir))


@query("loss_concentration",
       sql=f"""with {GOV_DAILY},
               per as (select sku, sum(lost_sales_gmv) as lost from gov_daily group by sku),
               t as (select coalesce(sum(lost), 0.0) as top_lost_gmv
                     from (select lost from per order by lost desc, sku limit 10)),
               a as (select coalesce(sum(lost), 0.0) as total_lost_gmv from per)
               select top_lost_gmv, total_lost_gmv,
                      case when total_lost_gmv > 0 then top_lost_gmv / total_lost_gmv else 0.0 end as top_share,
                      case when total_lost_gmv > 0 then top_lost_gmv / total_lost_gmv else 0.0 end > 0.6
                        as is_concentrated
               from t, a""",
       doubles=("top_lost_gmv", "total_lost_gmv", "top_share"))
def q_loss_concentration(spark, sf_dir):
    return gov.loss_concentration(_daily(spark, sf_dir))
