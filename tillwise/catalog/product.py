"""Registered product-analytics queries (title-only items T1-T3, T5-T11, T13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import product as pa
from tillwise.sources.fixtures import fx_activity
from tillwise.sources.tables import read_table


@query("sessionize",
       sql="""with e as (select user_id, epoch_us(ts) as t, event_id from events),
                   f as (select *, case when lag(t) over w is null or t - lag(t) over w > 1800000000 then 1 else 0 end
                                 as nw from e window w as (partition by user_id order by t, event_id)),
                   s as (select *, sum(nw) over (partition by user_id order by t, event_id
                                                 rows between unbounded preceding and current row) as session_idx
                         from f)
              select user_id, session_idx, min(t) as start_us, max(t) as end_us, count(*) as n_events,
                     (max(t) - min(t)) / 1000000.0 as duration_s
              from s group by 1, 2""",
       doubles=("duration_s",), longs=("session_idx",))
def q_sessionize(spark, sf_dir):
    return pa.sessionize(read_table(spark, sf_dir, "events"))


@query("nps",
       sql="""select event_type, count(s) as n,
                     100.0 * (avg(case when s >= 9 then 1.0 else 0.0 end) - avg(case when s <= 6 then 1.0 else 0.0 end))
                       as nps
              from (select event_type, cast(floor(value) as bigint) % 11 as s from events) group by 1""",
       doubles=("nps",))
def q_nps(spark, sf_dir):
    """T2 on a 0-10 score derived from the event value."""
    e = read_table(spark, sf_dir, "events").select("event_type", (F.floor("value") % 11).alias("s"))
    return pa.nps(e, "s", ["event_type"])


@query("ts_dashboard",
       sql="""with d as (select cast(ts as date) as day, sum(value) as value from events group by 1),
                   b as (select min(day) as lo, max(day) as hi from d),
                   cal as (select cast(g as date) as day from b, unnest(generate_series(b.lo, b.hi, interval 1 day)) t(g)),
                   j as (select cal.day, coalesce(d.value, 0.0) as value from cal left join d on d.day = cal.day)
              select day, value, avg(value) over (order by day rows between 6 preceding and current row) as moving_avg,
                     case when lag(value, 7) over (order by day) <> 0
                          then (value - lag(value, 7) over (order by day)) / lag(value, 7) over (order by day) end
                       as wow_change
              from j""",
       doubles=("value", "moving_avg", "wow_change"), strings=("day",))
def q_ts_dashboard(spark, sf_dir):
    return pa.daily_dashboard(fx_activity(spark, sf_dir), "day", "value")


MONTH = "cast(date_trunc('month', o_orderdate) as date)"


@query("arpu_aov",
       sql=f"""select {MONTH} as month, sum(o_totalprice) as revenue, count(distinct o_custkey) as users,
                      count(*) as orders, sum(o_totalprice) / count(distinct o_custkey) as arpu,
                      sum(o_totalprice) / count(*) as aov
               from orders group by 1""",
       doubles=("revenue", "arpu", "aov"), strings=("month",))
def q_arpu_aov(spark, sf_dir):
    return pa.arpu_aov(read_table(spark, sf_dir, "orders"))


@query("average_check",
       sql=f"""select {MONTH} as month, avg(o_totalprice) as mean_check,
                      quantile_cont(o_totalprice, 0.5) as median_check, count(*) as orders
               from orders group by 1""",
       doubles=("mean_check", "median_check"), strings=("month",))
def q_average_check(spark, sf_dir):
    return pa.average_check(read_table(spark, sf_dir, "orders"))


@query("payments_daily",
       sql="""select cast(o_orderdate as date) as day, sum(o_totalprice) as amount,
                     coalesce(sum(o_totalprice) filter (where o_orderstatus = 'F'), 0.0) as paid_amount,
                     avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end) as share_f,
                     avg(case when o_orderstatus = 'O' then 1.0 else 0.0 end) as share_o,
                     avg(case when o_orderstatus = 'P' then 1.0 else 0.0 end) as share_p
              from orders group by 1""",
       doubles=("amount", "paid_amount", "share_f", "share_o", "share_p"), strings=("day",))
def q_payments_daily(spark, sf_dir):
    return pa.payments_daily(read_table(spark, sf_dir, "orders"))


@query("mrr",
       sql=f"""with cm as (select o_custkey, {MONTH} as month, sum(o_totalprice) as rev from orders group by 1, 2),
                    l as (select max(month) as last from cm),
                    f as (select o_custkey, min(month) as m0 from cm group by 1),
                    grid as (select f.o_custkey, cast(g as date) as month
                             from f, l, unnest(generate_series(f.m0, l.last + interval 1 month, interval 1 month)) t(g)),
                    g as (select grid.o_custkey, grid.month, coalesce(cm.rev, 0.0) as rev
                          from grid left join cm on cm.o_custkey = grid.o_custkey and cm.month = grid.month),
                    k as (select *, lag(rev) over (partition by o_custkey order by month) as prev from g),
                    c as (select *, case when prev is null and rev > 0 then 'new'
                                         when prev > 0 and rev > prev then 'expansion'
                                         when prev > 0 and rev > 0 and rev < prev then 'contraction'
                                         when prev > 0 and rev = 0 then 'churned'
                                         when prev = 0 and rev > 0 then 'reactivated' end as kind,
                                 rev - coalesce(prev, 0.0) as delta from k)
               select month, sum(rev) as mrr,
                      coalesce(sum(delta) filter (where kind = 'new'), 0.0) as new,
                      coalesce(sum(delta) filter (where kind = 'expansion'), 0.0) as expansion,
                      coalesce(sum(delta) filter (where kind = 'contraction'), 0.0) as contraction,
                      coalesce(sum(delta) filter (where kind = 'churned'), 0.0) as churned,
                      coalesce(sum(delta) filter (where kind = 'reactivated'), 0.0) as reactivated
               from c group by month""",
       doubles=("mrr", "new", "expansion", "contraction", "churned", "reactivated"), strings=("month",))
def q_mrr(spark, sf_dir):
    return pa.mrr_movements(read_table(spark, sf_dir, "orders"))


@query("retention_day_n",
       sql="""with ud as (select distinct user_id as u, day as d from fx_activity),
                   hi as (select max(d) as hi from ud),
                   f as (select u, min(d) as d0 from ud group by u),
                   ns as (select * from (values (1), (7), (14)) t(n))
              select ns.n, count(*) as cohort_users, count(a.u) as retained_users,
                     case when count(*) <> 0 then count(a.u) / count(*) end as retention
              from f cross join ns join hi on f.d0 + ns.n <= hi.hi
              left join ud a on a.u = f.u and a.d = f.d0 + ns.n
              group by ns.n""",
       doubles=("retention",), longs=("n",))
def q_retention_day_n(spark, sf_dir):
    return pa.retention_day_n(fx_activity(spark, sf_dir))


@query("cohort_retention",
       sql="""with uw as (select distinct user_id as u, cast(date_trunc('week', day) as date) as wk from fx_activity),
                   f as (select u, min(wk) as cohort from uw group by u),
                   sz as (select cohort, count(*) as cohort_size from f group by cohort),
                   a as (select f.cohort, cast(datediff('day', f.cohort, uw.wk) / 7 as integer) as period,
                                count(*) as users
                         from uw join f on f.u = uw.u group by 1, 2)
              select a.cohort, a.period, a.users, sz.cohort_size, a.users / sz.cohort_size as retention
              from a join sz on sz.cohort = a.cohort""",
       doubles=("retention",), strings=("cohort",), longs=("period",))
def q_cohort_retention(spark, sf_dir):
    return pa.cohort_retention(fx_activity(spark, sf_dir))


@query("churn_dataset",
       sql="""with o as (select o_custkey, cast(o_orderdate as date) as d, o_totalprice from orders),
                   r as (select max(d) - 90 as ref from o),
                   past as (select o_custkey, count(*) as n_orders, sum(o_totalprice) as total_spent,
                                   datediff('day', max(d), (select ref from r)) as days_since_last
                            from o where d <= (select ref from r) group by 1),
                   fut as (select distinct o_custkey from o, r where d > r.ref and d <= r.ref + 90)
              select p.*, case when f.o_custkey is null then 1 else 0 end as churned
              from past p left join fut f on f.o_custkey = p.o_custkey""",
       doubles=("total_spent",), longs=("days_since_last", "churned"))
def q_churn_dataset(spark, sf_dir):
    return pa.churn_dataset(read_table(spark, sf_dir, "orders"))


@query("rfm_segments",
       sql="""with c as (select o_custkey,
                               datediff('day', max(cast(o_orderdate as date)),
                                        (select max(cast(o_orderdate as date)) from orders)) as recency,
                               count(*) as frequency, sum(o_totalprice) as monetary
                        from orders group by 1),
                   s as (select *, ntile(5) over (order by recency desc, o_custkey) as r_score,
                                ntile(5) over (order by frequency, o_custkey) as f_score,
                                ntile(5) over (order by monetary, o_custkey) as m_score from c)
              select *, cast(r_score as varchar) || cast(f_score as varchar) || cast(m_score as varchar) as segment
              from s""",
       doubles=("monetary",), longs=("recency", "r_score", "f_score", "m_score"))
def q_rfm_segments(spark, sf_dir):
    return pa.rfm_segments(read_table(spark, sf_dir, "orders"))
