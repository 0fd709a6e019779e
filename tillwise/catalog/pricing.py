"""Registered pricing queries (fixtures ``fx_price_candidates``, ``fx_candidates_raw``)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import metrics as mt
from tillwise.operators import pricing as pr
from tillwise.plans.margin import margin_plan_run
from tillwise.sources.fixtures import fx_candidates_raw, fx_price_candidates

TARGET = 0.2
CAND_DOUBLES = ("cost", "price")
MET_DOUBLES = ("cost", "price", "gmv", "margin", "gp")

# DuckDB building blocks
VALID_SQL = """
valid as (select * from fx_candidates_raw
          where cost is not null and not isnan(cost) and price is not null and not isnan(price)
            and qty is not null and price > 0 and qty >= 0 and cost >= 0)"""
CM_SQL = """
cm as (select sku, category, cost, price, qty, scenario_id, price * qty as gmv,
              (price - cost) / price as margin, (price - cost) * qty as gp
       from fx_price_candidates),
plan0 as (select * from cm qualify row_number() over (partition by sku order by gmv desc, margin desc, price) = 1)"""
REPAIR_SQL = CM_SQL + """,
t0 as (select sum(gmv) as g0, sum(gmv * margin) as w0 from plan0),
rc as (select c.sku, c.price as new_price, c.cost as new_cost, c.qty as new_qty, c.gmv as new_gmv,
              c.margin as new_margin, c.gp as new_gp, c.gmv - p.gmv as delta_gmv, c.margin - p.margin as delta_margin,
              case when c.gmv - p.gmv >= 0 then -1e9 else greatest(p.gmv - c.gmv, 0.0) / (c.margin - p.margin) end
                as repair_score,
              c.gmv * c.margin - p.gmv * p.margin as delta_w
       from cm c join plan0 p on c.sku = p.sku where c.margin - p.margin > 0),
best as (select * from rc
         qualify row_number() over (partition by sku order by repair_score, delta_margin desc, new_price) = 1),
cum as (select *, row_number() over o as repair_rank, sum(delta_gmv) over o as cum_gmv, sum(delta_w) over o as cum_w
        from best window o as (order by repair_score, delta_margin desc, new_price, sku
                               rows between unbounded preceding and current row)),
wmk as (select cum.*, case when g0 + cum_gmv <= 0 then 0.0 else (w0 + cum_w) / (g0 + cum_gmv) end as wm
        from cum, t0),
kk as (select case when (select case when g0 <= 0 then 0.0 else w0 / g0 end from t0) >= {target} then 0
                   else coalesce(min(repair_rank) filter (where wm >= {target}), max(repair_rank), 0) end as kstar
       from wmk),
applied as (select wmk.* from wmk, kk where repair_rank <= kstar),
repaired as (
  select p.sku, p.category, coalesce(a.new_price, p.price) as price, coalesce(a.new_cost, p.cost) as cost,
         coalesce(a.new_qty, p.qty) as qty, coalesce(a.new_gmv, p.gmv) as gmv,
         coalesce(a.new_margin, p.margin) as margin, coalesce(a.new_gp, p.gp) as gp, a.sku is not null as repaired
  from plan0 p left join applied a on a.sku = p.sku)"""
CONTRIB_SQL = REPAIR_SQL + """,
tg as (select sum(gmv) as tot from repaired),
contrib as (select r.*, case when tot > 0 then gmv / tot else 0.0 end as gmv_penetration,
                   case when tot > 0 then gmv / tot else 0.0 end * margin as weighted_margin_contribution
            from repaired r, tg)"""


def _cm(spark, sf_dir):
    return pr.candidate_metrics(fx_price_candidates(spark, sf_dir))


def _repaired(spark, sf_dir, target=TARGET):
    cm = _cm(spark, sf_dir)
    plan, meta = pr.plan_repair(cm, pr.plan_max_gmv(cm), target)
    return plan, meta


@query("extract_candidates",
       sql="select sku, category, cost, price, qty, scenario_id from fx_candidates_raw where qty is not null",
       doubles=CAND_DOUBLES)
def q_extract_candidates(spark, sf_dir):
    return pr.extract_candidates(fx_candidates_raw(spark, sf_dir))


@query("filter_scope",
       sql="""select * from fx_price_candidates
              where cast(category as varchar) = 'PROMO' and cast(scenario_id as varchar) = 'promo'""",
       doubles=CAND_DOUBLES)
def q_filter_scope(spark, sf_dir):
    return pr.filter_scope(fx_price_candidates(spark, sf_dir), category="PROMO", scenario="promo")


@query("coerce_numeric",
       sql="""select sku, try_cast(cost_s as double) as cost, try_cast(price_s as double) as price,
                     try_cast(qty_s as double) as qty
              from (select sku, case when sku % 13 = 0 then 'n/a' else cast(cost as varchar) end as cost_s,
                           cast(price as varchar) as price_s,
                           case when sku % 17 = 0 then '' else cast(qty as varchar) end as qty_s
                    from fx_price_candidates)""",
       doubles=("cost", "price", "qty"))
def q_coerce_numeric(spark, sf_dir):
    c = fx_price_candidates(spark, sf_dir)
    s = c.select("sku",
                 F.when(F.col("sku") % 13 == 0, F.lit("n/a")).otherwise(F.col("cost").cast("string")).alias("cost"),
                 F.col("price").cast("string").alias("price"),
                 F.when(F.col("sku") % 17 == 0, F.lit("")).otherwise(F.col("qty").cast("string")).alias("qty"))
    return pr.coerce_numeric(s)


@query("dq_report",
       sql="""select r.*, x.dq_reason from fx_candidates_raw r,
              unnest([case when r.cost is null or isnan(r.cost) then 'cost_is_nan' end,
                      case when r.price is null or isnan(r.price) then 'price_is_nan' end,
                      case when r.qty is null then 'qty_is_nan' end,
                      case when r.price <= 0 then 'price_le_0' end,
                      case when r.qty < 0 then 'qty_lt_0' end,
                      case when r.cost < 0 then 'cost_lt_0' end]) as x(dq_reason)
              where x.dq_reason is not null""",
       doubles=CAND_DOUBLES)
def q_dq_report(spark, sf_dir):
    return pr.dq_report(fx_candidates_raw(spark, sf_dir))


@query("valid_rows", sql=f"with {VALID_SQL} select * from valid", doubles=CAND_DOUBLES)
def q_valid_rows(spark, sf_dir):
    return pr.valid_rows(fx_candidates_raw(spark, sf_dir))


@query("dedup_candidates",
       sql=f"""with {VALID_SQL} select sku, category, cost, price, qty, scenario_id from valid
               qualify row_number() over (partition by sku, category, cost, price, qty order by scenario_id) = 1""",
       doubles=CAND_DOUBLES)
def q_dedup_candidates(spark, sf_dir):
    return pr.dedup_candidates(pr.valid_rows(fx_candidates_raw(spark, sf_dir)))


@query("candidate_metrics", sql=f"with {CM_SQL} select * from cm", doubles=MET_DOUBLES)
def q_candidate_metrics(spark, sf_dir):
    return _cm(spark, sf_dir)


@query("plan_max_gmv", sql=f"with {CM_SQL} select * from plan0", doubles=MET_DOUBLES)
def q_plan_max_gmv(spark, sf_dir):
    return pr.plan_max_gmv(_cm(spark, sf_dir))


@query("plan_max_margin",
       sql=f"""with {CM_SQL} select * from cm
               qualify row_number() over (partition by sku order by margin desc, gmv desc, price) = 1""",
       doubles=MET_DOUBLES)
def q_plan_max_margin(spark, sf_dir):
    return pr.plan_max_margin(_cm(spark, sf_dir))


@query("argmax_per_group",
       sql=f"""with {CM_SQL} select category, sku, price, gp from cm
               qualify row_number() over (partition by category order by gp desc, sku, price) = 1""",
       doubles=("price", "gp"))
def q_argmax_per_group(spark, sf_dir):
    """per category the candidate with the largest gross profit."""
    cm = _cm(spark, sf_dir).select("category", "sku", "price", "gp")
    return pr._argmax(cm, "category", [F.col("gp"), -F.col("sku"), -F.col("price")])


@query("idxmax_per_group",
       sql=f"""with {CM_SQL} select sku, price, gmv from cm
               qualify row_number() over (partition by sku order by gmv desc, price desc) = 1""",
       doubles=("price", "gmv"))
def q_idxmax_per_group(spark, sf_dir):
    """first row (rows ordered by descending price) of the GMV maximum."""
    cm = _cm(spark, sf_dir).select("sku", "price", "gmv")
    return pr.first_argmax(cm, "sku", "gmv", [-F.col("price")])


@query("argmax_all_ties",
       sql="""select sku, price, qty, price = max(price) over (partition by sku) as is_selected
              from (select sku, round(price, 0) as price, qty from fx_price_candidates)""",
       doubles=("price",))
def q_argmax_all_ties(spark, sf_dir):
    """F5 / M18 mask on whole-unit prices, so several rows can tie at the max."""
    c = fx_price_candidates(spark, sf_dir).select("sku", F.round("price", 0).alias("price"), "qty")
    return pr.argmax_all_ties(c)


@query("price_mask_baseline",
       sql="""select sku, scenario_id, price, price = max(price) over (partition by sku) as is_selected
              from fx_price_candidates""",
       doubles=("price",))
def q_price_mask_baseline(spark, sf_dir):
    c = fx_price_candidates(spark, sf_dir).select("sku", "scenario_id", "price")
    return pr.argmax_all_ties(c)


@query("weighted_margin",
       sql=f"""with {CM_SQL},
               pm as (select * from cm
                      qualify row_number() over (partition by sku order by margin desc, gmv desc, price) = 1)
               select 'max_gmv' as plan, case when sum(gmv) <= 0 then 0.0 else sum(gmv * margin) / sum(gmv) end
                        as weighted_margin from plan0
               union all
               select 'max_margin', case when sum(gmv) <= 0 then 0.0 else sum(gmv * margin) / sum(gmv) end from pm""",
       doubles=("weighted_margin",))
def q_weighted_margin(spark, sf_dir):
    cm = _cm(spark, sf_dir)
    a = mt.weighted_margin(pr.plan_max_gmv(cm)).select(F.lit("max_gmv").alias("plan"), "weighted_margin")
    b = mt.weighted_margin(pr.plan_max_margin(cm)).select(F.lit("max_margin").alias("plan"), "weighted_margin")
    return a.unionByName(b)


@query("union_all",
       sql=f"""with {CM_SQL},
               pm as (select * from cm
                      qualify row_number() over (partition by sku order by margin desc, gmv desc, price) = 1)
               select 'max_gmv' as plan, sku, price, gmv from plan0
               union all select 'max_margin', sku, price, gmv from pm""",
       doubles=("price", "gmv"))
def q_union_all(spark, sf_dir):
    """G1: both per-SKU plans stacked with a label column."""
    cm = _cm(spark, sf_dir)
    a = pr.plan_max_gmv(cm).select(F.lit("max_gmv").alias("plan"), "sku", "price", "gmv")
    b = pr.plan_max_margin(cm).select(F.lit("max_margin").alias("plan"), "sku", "price", "gmv")
    return a.unionByName(b)


@query("plan_repair",
       sql="with " + REPAIR_SQL.format(target=TARGET) + " select * from repaired",
       doubles=MET_DOUBLES)
def q_plan_repair(spark, sf_dir):
    return _repaired(spark, sf_dir)[0]


@query("plan_summary",
       sql="with " + REPAIR_SQL.format(target=TARGET) + f"""
            select category, {TARGET} as target_margin,
                   case when coalesce(sum(gmv), 0) <= 0 then 0.0 else sum(gmv * margin) / sum(gmv) end
                     as weighted_margin,
                   (case when coalesce(sum(gmv), 0) <= 0 then 0.0 else sum(gmv * margin) / sum(gmv) end
                     - {TARGET}) * 100.0 as margin_buffer_pp,
                   sum(gmv) as total_gmv, sum(gp) as total_gp, count(distinct sku) as n_skus
            from repaired group by category""",
       doubles=("target_margin", "weighted_margin", "margin_buffer_pp", "total_gmv", "total_gp"))
def q_plan_summary(spark, sf_dir):
    return pr.plan_summary(_repaired(spark, sf_dir)[0], TARGET, by=["category"])


@query("plan_contribution",
       sql="with " + CONTRIB_SQL.format(target=TARGET) + """
            select sku, gmv, margin, gmv_penetration, weighted_margin_contribution from contrib""",
       doubles=("gmv", "margin", "gmv_penetration", "weighted_margin_contribution"))
def q_plan_contribution(spark, sf_dir):
    return pr.plan_contribution(_repaired(spark, sf_dir)[0]).select(
        "sku", "gmv", "margin", "gmv_penetration", "weighted_margin_contribution")


@query("top_n",
       sql="with " + CONTRIB_SQL.format(target=TARGET) + """
            select * from (select sku, weighted_margin_contribution, 'support' as side from contrib
                           order by weighted_margin_contribution desc, sku limit 20)
            union all
            select * from (select sku, weighted_margin_contribution, 'damage' as side from contrib
                           order by weighted_margin_contribution asc, sku limit 20)""",
       doubles=("weighted_margin_contribution",))
def q_top_n(spark, sf_dir):
    c = pr.plan_contribution(_repaired(spark, sf_dir)[0]).select("sku", "weighted_margin_contribution")
    return pr.top_n(c, 20)


@query("plan_actions",
       sql="with " + CONTRIB_SQL.format(target=TARGET) + """
            select sku, margin, gmv_penetration, 'negative_margin_high_penetration' as issue,
                   'Review promo depth / negotiate cost / adjust price floor / replace SKU in promo set'
                     as recommended_action
            from contrib where margin < 0 and gmv_penetration >= 0.0002""",
       doubles=("margin", "gmv_penetration"))
def q_plan_actions(spark, sf_dir):
    """M14 with a penetration floor scaled to a 2,000-SKU plan."""
    c = pr.plan_contribution(_repaired(spark, sf_dir)[0])
    return pr.plan_actions(c, 0.0002).select("sku", "margin", "gmv_penetration", "issue", "recommended_action")


@query("plan_alerts",
       sql="with " + CONTRIB_SQL.format(target=TARGET) + f""",
            s as (select count(*) as n,
                         case when coalesce(sum(gmv), 0) <= 0 then 0.0 else sum(gmv * margin) / sum(gmv) end as wm
                  from repaired),
            rk as (select count(*) filter (where margin < 0 and gmv_penetration >= 0.05) as risk from contrib)
            select 'ALERT' as level, 'empty_plan' as code, 'No valid rows after data quality filtering.' as message
              from s where n = 0
            union all
            select 'ALERT', 'infeasible_or_not_met',
                   'weighted_margin=' || format('{{:.4f}}', wm) || ' < target=' || format('{{:.4f}}', {TARGET}) || '.'
              from s where n > 0 and wm < {TARGET}
            union all
            select 'ALERT', 'low_margin_buffer',
                   'buffer=' || format('{{:.2f}}', (wm - {TARGET}) * 100.0)
                   || 'pp. Risk of missing target due to forecast error / cost change.'
              from s where n > 0 and (wm - {TARGET}) * 100.0 < 1.0 and wm >= {TARGET}
            union all
            select 'ALERT', 'loss_leader_penetration',
                   'Negative margin SKUs have high GMV penetration. Check pricing strategy and supplier conditions.'
              from s, rk where n > 0 and risk > 0
            union all
            select 'INFO', 'top_support_skus', string_agg(cast(sku as varchar), ', ' order by w desc, sku)
              from (select sku, weighted_margin_contribution as w from contrib
                    order by weighted_margin_contribution desc, sku limit 10)
            union all
            select 'INFO', 'top_damage_skus', string_agg(cast(sku as varchar), ', ' order by w, sku)
              from (select sku, weighted_margin_contribution as w from contrib
                    order by weighted_margin_contribution, sku limit 10)""")
def q_plan_alerts(spark, sf_dir):
    plan = _repaired(spark, sf_dir)[0]
    return pr.plan_alerts(plan, pr.plan_contribution(plan), TARGET)


@query("margin_plan_run",
       sql="with " + REPAIR_SQL.format(target=TARGET) + " select * from repaired",
       doubles=MET_DOUBLES)
def q_margin_plan_run(spark, sf_dir):
    """Validate -> metrics -> max-GMV plan -> repair; the final plan."""
    return margin_plan_run(fx_price_candidates(spark, sf_dir), TARGET)["plan"]


# the SKU scan as a recursion over SKUs in order: per step the candidates by falling margin, the first that meets the
# target, and a swap only if its GMV is not lower; slack = sum((margin - target) * gmv)
PM_SQL = """
with recursive cm as (select *, price * qty as gmv, (price - cost) / price as margin from {src}),
g as (select * from cm qualify row_number() over (partition by sku order by gmv desc, price desc, cost {dear}) = 1),
mm as (select * from cm qualify row_number() over (partition by sku order by margin desc, price desc, cost) = 1),
goal as (select {t} as t from g),
total as (select sum((margin - t) * gmv) as slack from g, goal),
steps as (select sku, gmv, (margin - t) * gmv as worth, row_number() over (order by sku) as n from g, goal),
trial as (select steps.n, cm.sku, cm.price, cm.cost, cm.gmv >= steps.gmv as swap, (cm.margin - t) * cm.gmv - steps.worth as gain,
                 row_number() over (partition by cm.sku order by cm.margin desc, cm.price desc, cm.cost) as place
          from goal, cm join steps on steps.sku = cm.sku),
scan(n, slack, price, cost) as (
  select cast(0 as bigint), slack, cast(null as double), cast(null as double) from total
  union all
  select s.n + 1, case when pick.swap then s.slack + pick.gain else s.slack end,
         case when pick.swap then pick.price end, case when pick.swap then pick.cost end
  from (select * from scan, total where total.slack < 0 and n < (select count(*) from steps)) s(n, slack, price, cost, s0)
  left join lateral (select t.swap, t.gain, t.price, t.cost from trial t
                     where t.n = s.n + 1 and s.slack + t.gain >= 0 order by t.place limit 1) pick on true),
final as (select arg_max(slack, n) as slack from scan),
pick as (select g.sku, coalesce(scan.price, g.price) as price, coalesce(scan.cost, g.cost) as cost
         from g join steps on steps.sku = g.sku left join scan on scan.n = steps.n, final where final.slack >= 0
         union all select mm.sku, mm.price, mm.cost from mm, final where final.slack < 0)
select c.sku, c.category, c.cost, c.price, c.qty, c.scenario_id, p.sku is not null as is_selected
from {src} c left join pick p on p.sku = c.sku and p.price = c.price and p.cost = c.cost"""


@query("price_mask", sql=PM_SQL.format(t="max(0.2)", src="fx_price_candidates", dear=""), doubles=CAND_DOUBLES)
def q_price_mask(spark, sf_dir):
    """M17 at target 0.2 (the max-GMV plan misses it -> max-margin fallback)."""
    return pr.price_mask(fx_price_candidates(spark, sf_dir), 0.2, [-F.col("price"), F.col("cost")])


#: every third SKU may also be bought from a second supplier, at the same price and demand: GMV ties
TIES_SRC = """(select * from fx_price_candidates union all
               select sku, category, cost * (0.9 + (hash_sku % 7) * 0.01), price, qty, scenario_id
               from (select *, cast(sku as bigint) * 31 as hash_sku from fx_price_candidates) where sku % 3 = 0)"""


def _two_suppliers(spark, sf_dir):
    c = fx_price_candidates(spark, sf_dir)
    cheaper = F.col("cost") * (F.lit(0.9) + (F.col("sku").cast("long") * 31 % 7) * F.lit(0.01))
    return c.unionByName(c.where(F.col("sku") % 3 == 0).withColumn("cost", cheaper))


@query("price_mask_ties", sql=PM_SQL.format(t="ceil(sum(gmv * margin) / sum(gmv) * 1e5) / 1e5", src=TIES_SRC, dear="desc"), doubles=CAND_DOUBLES)
def q_price_mask_ties(spark, sf_dir):
    """M17 where GMV ties let the scan swap single SKUs: the dearer supplier
    comes first, so the max-GMV plan misses the target that ties can reach."""
    c, order = _two_suppliers(spark, sf_dir), [-F.col("price"), -F.col("cost")]
    best = pr.totals(pr.first_argmax(pr.candidate_metrics(c), "sku", "gmv", order))
    # the next 0.001 % above what the max-GMV plan reaches: a single swap can close the gap
    return pr.price_mask(c, math.ceil(pr.wm_of(*best) * 1e5) / 1e5, order)


@query("price_mask_feasible", sql=PM_SQL.format(t="max(0.15)", src="fx_price_candidates", dear=""), doubles=CAND_DOUBLES)
def q_price_mask_feasible(spark, sf_dir):
    """M17 at target 0.15 (the max-GMV plan already meets it)."""
    return pr.price_mask(fx_price_candidates(spark, sf_dir), 0.15, [-F.col("price"), F.col("cost")])
