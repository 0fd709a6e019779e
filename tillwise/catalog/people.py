"""Registered activity, organisation, imputation and loan queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import activity as act
from tillwise.operators import hierarchy as hier
from tillwise.operators import imputation as imp
from tillwise.sources.fixtures import fx_activity, fx_cold_start, fx_employees, fx_loans

WAU_SQL = """
ud as (select distinct day, user_id from fx_activity),
b as (select min(day) as lo, max(day) as hi from ud),
cal as (select cast(g as date) as day from b, unnest(generate_series(b.lo, b.hi, interval 1 day)) as t(g)),
wau as (select c.day, count(distinct case when u.day = c.day then u.user_id end) as dau,
               count(distinct u.user_id) as wau
        from cal c left join ud u on u.day between c.day - 6 and c.day group by c.day),
sticky as (select day, dau, wau, case when wau > 0 then dau / wau else 0.0 end as sticky_factor from wau)"""


@query("dau", sql="select day, count(distinct user_id) as dau from fx_activity group by day", strings=("day",))
def q_dau(spark, sf_dir):
    return act.dau(fx_activity(spark, sf_dir))


@query("wau_rolling", sql=f"with {WAU_SQL} select * from sticky", doubles=("sticky_factor",), strings=("day",))
def q_wau_rolling(spark, sf_dir):
    return act.rolling_active_users(fx_activity(spark, sf_dir))


@query("describe_percentiles",
       sql=f"""with {WAU_SQL}
               select count(sticky_factor) as count, avg(sticky_factor) as mean, stddev_samp(sticky_factor) as std,
                      min(sticky_factor) as min, quantile_cont(sticky_factor, 0.1) as p10,
                      quantile_cont(sticky_factor, 0.25) as p25, quantile_cont(sticky_factor, 0.5) as p50,
                      quantile_cont(sticky_factor, 0.75) as p75, quantile_cont(sticky_factor, 0.9) as p90,
                      max(sticky_factor) as max
               from sticky""",
       doubles=("mean", "std", "min", "p10", "p25", "p50", "p75", "p90", "max"))
def q_describe_percentiles(spark, sf_dir):
    return act.describe(act.rolling_active_users(fx_activity(spark, sf_dir)), "sticky_factor")


@query("approx_distinct_wau", note="HLL estimate: rows-only check (approximate by design)")
def q_approx_distinct_wau(spark, sf_dir):
    return act.approx_rolling_active_users(fx_activity(spark, sf_dir))


@query("approx_distinct_wau_error", sql=f"with {WAU_SQL} select day, wau, true as within_5_percent from wau", strings=("day",))
def q_approx_distinct_wau_error(spark, sf_dir):
    """D14 held against the exact count: within 5 % (or one user) every day."""
    est = act.approx_rolling_active_users(fx_activity(spark, sf_dir))
    name = [c for c in est.columns if c != "day"][-1]
    exact = act.rolling_active_users(fx_activity(spark, sf_dir)).select("day", "wau")
    near = F.abs(F.col("_est") - F.col("wau")) <= F.greatest(F.lit(1.0), F.col("wau") * 0.05)
    return exact.join(est.select("day", F.col(name).alias("_est")), "day", "left").select(
        "day", "wau", (near | F.col("_est").isNull() & (F.col("wau") == 0)).alias("within_5_percent"))


# every employee walks up to the root: the walk's length is the level, and the
# walks that pass an employee are that employee's team
ORG_SQL = """
recursive walk as (select employee_id as member, employee_id as boss, 0 as steps from fx_employees
                   union all
                   select walk.member, up.manager_id, walk.steps + 1 from walk, fx_employees as up
                   where up.employee_id = walk.boss and up.manager_id is not null),
depths as (select member, max(steps) + 1 as level from walk group by member),
teams as (select walk.boss, count(*) filter (where walk.steps > 0) as team_size, sum(m.salary) as budget
          from walk, fx_employees as m where m.employee_id = walk.member group by walk.boss)"""


@query("org_level", sql=f"with {ORG_SQL} select member as employee_id, level from depths", longs=("level",))
def q_org_level(spark, sf_dir):
    return hier.org_levels(fx_employees(spark, sf_dir))


@query("org_closure", sql=f"with {ORG_SQL} select boss as manager_id, member as subordinate_id from walk")
def q_org_closure(spark, sf_dir):
    return hier.org_closure(fx_employees(spark, sf_dir))


@query("org_rollup", sql=f"with {ORG_SQL} select boss as employee_id, team_size, budget from teams", doubles=("budget",))
def q_org_rollup(spark, sf_dir):
    return hier.org_rollup(fx_employees(spark, sf_dir))


REPORT_SQL = f"""with {ORG_SQL}
select p.employee_id, p.employee_name, depths.level, teams.team_size, teams.budget
from depths, teams, fx_employees as p where depths.member = p.employee_id and teams.boss = p.employee_id"""


@query("join_inner_multi", sql=f"""with {ORG_SQL}
select p.employee_id, p.employee_name, depths.level, boss.employee_name as manager_name
from fx_employees as p join depths on depths.member = p.employee_id
                       join fx_employees as boss on boss.employee_id = p.manager_id""", longs=("level",))
def q_join_inner_multi(spark, sf_dir):
    """Employees joined with their level and their manager's row."""
    emp = fx_employees(spark, sf_dir)
    boss = emp.select(F.col("employee_id").alias("manager_id"), F.col("employee_name").alias("manager_name"))
    return (emp.select("employee_id", "employee_name", "manager_id").join(hier.org_levels(emp), "employee_id")
            .join(boss, "manager_id").select("employee_id", "employee_name", "level", "manager_name"))


@query("org_report", sql=REPORT_SQL, doubles=("budget",), longs=("level",))
def q_org_report(spark, sf_dir):
    return hier.org_report(fx_employees(spark, sf_dir))


COLD_COLS = "l_orderkey, l_linenumber, category"


@query("group_mean",
       sql=f"select {COLD_COLS}, sales, avg(sales) over (partition by category) as group_mean from fx_cold_start",
       doubles=("sales", "group_mean"))
def q_group_mean(spark, sf_dir):
    return imp.group_mean(fx_cold_start(spark, sf_dir), "sales", "category")


@query("group_mean_fill",
       sql=f"""select {COLD_COLS}, coalesce(sales, avg(sales) over (partition by category)) as sales
               from fx_cold_start""",
       doubles=("sales",))
def q_group_mean_fill(spark, sf_dir):
    return imp.group_mean_fill(fx_cold_start(spark, sf_dir), "sales", "category")


@query("fill_group_mean_floor",
       sql=f"""select {COLD_COLS}, coalesce(sales, floor(avg(sales) over (partition by category))) as sales
               from fx_cold_start""",
       doubles=("sales",))
def q_fill_group_mean_floor(spark, sf_dir):
    return imp.fill_group_mean_floor(fx_cold_start(spark, sf_dir), "sales", "category")


@query("fill_group_mean_floor_all",
       sql=f"""select {COLD_COLS}, floor(coalesce(sales, avg(sales) over (partition by category))) as sales
               from fx_cold_start""",
       doubles=("sales",))
def q_fill_group_mean_floor_all(spark, sf_dir):
    return imp.fill_group_mean_floor(fx_cold_start(spark, sf_dir), "sales", "category", floor_all=True)


@query("loan_features",
       sql="""select id, age, income, dependents, has_property, has_car, loan_amount,
                     datediff('day', loan_start, loan_deadline) as loan_period,
                     case when loan_payed <= loan_deadline then 0
                          else datediff('day', loan_deadline, loan_payed) end as delay_days
              from fx_loans order by id""",
       doubles=("income", "loan_amount"),
       longs=("age", "dependents", "has_property", "has_car", "loan_period", "delay_days"))
def q_loan_features(spark, sf_dir):
    return imp.loan_features(fx_loans(spark, sf_dir))
