"""Registered scans, scalar-function and small relational queries (A2, A5,
D9, E9, F1, G2, H1-H7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.functions import dates as dt
from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.sources.fixtures import fx_delivery, fx_price_candidates
from tillwise.sources.files import key_union
from tillwise.sources.tables import read_table


@query("scan_table",
       sql="""select l_orderkey, l_partkey, l_quantity, l_extendedprice from lineitem
              where l_shipdate >= timestamp '1997-01-01' and l_returnflag = 'R'""",
       doubles=("l_quantity", "l_extendedprice"))
def q_scan_table(spark, sf_dir):
    """A5: parquet scan with the projection and filters pushed into the reader."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.where((F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                    & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_partkey", "l_quantity",
                                                             "l_extendedprice")


@query("parse_time",
       sql="""select o_orderkey, try_strptime(s, '%d/%m/%Y') as parsed
              from (select o_orderkey, case when o_orderkey % 10 = 0 then 'not a date'
                                            else strftime(o_orderdate, '%d/%m/%Y') end as s from orders)""",
       strings=("parsed",))
def q_parse_time(spark, sf_dir):
    """A2: day-first date strings parsed, unparsable ones NULL."""
    o = read_table(spark, sf_dir, "orders")
    s = F.when(F.col("o_orderkey") % 10 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", dt.parse_time(s, day_first=True).alias("parsed"))


@query("week_conventions",
       sql="""select d as day, cast(date_trunc('week', d) as date) as monday,
                     d - cast(dayofweek(d) as integer) as sunday_start,
                     d + cast((7 - dayofweek(d)) % 7 as integer) as sunday_end,
                     strftime(cast(date_trunc('week', d) as date), '%Y-%m-%d') || '/' ||
                       strftime(cast(date_trunc('week', d) as date) + 6, '%Y-%m-%d') as mon_sun_label,
                     strftime(d, '%Y-%m-%d') as day_string,
                     datediff('day', d, cast(date_trunc('month', d) as date) + interval 1 month) as days_to_month_end
              from (select distinct cast(l_shipdate as date) as d from lineitem)""",
       strings=("day", "monday", "sunday_start", "sunday_end"))
def q_week_conventions(spark, sf_dir):
    """H1-H7: the four week conventions, day strings and day differences."""
    d = read_table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    month_end = F.add_months(F.trunc("day", "month"), 1)
    return d.select("day", dt.week_key("day", "monday").alias("monday"),
                    dt.week_key("day", "sunday_start").alias("sunday_start"),
                    dt.week_key("day", "sunday_end").alias("sunday_end"),
                    dt.week_key("day", "mon_sun_label").alias("mon_sun_label"),
                    dt.day_string("day").alias("day_string"),
                    dt.days_between("day", month_end).alias("days_to_month_end"))


@query("distinct_count_cols",
       sql="""select category, count(distinct sku) as n_skus, count(distinct scenario_id) as n_scenarios
              from fx_price_candidates group by category""")
def q_distinct_count_cols(spark, sf_dir):
    """Distinct counts per group."""
    return fx_price_candidates(spark, sf_dir).groupBy("category").agg(
        F.countDistinct("sku").alias("n_skus"), F.countDistinct("scenario_id").alias("n_scenarios"))


@query("key_union",
       sql="""select product from (select product from fx_delivery
                                   union select l_partkey from lineitem
                                   union select ps from (select p_partkey as ps from part)) order by product""")
def q_key_union(spark, sf_dir):
    """Sorted distinct union of the key sets of several tables."""
    a = fx_delivery(spark, sf_dir).select("product")
    b = read_table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product"))
    c = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"))
    return key_union([a, b, c], "product")


@query("prefix_until_target",
       sql="""with c as (select c_custkey, c_acctbal,
                                sum(greatest(c_acctbal, 0)) over (order by c_acctbal desc, c_custkey
                                                                  rows between unbounded preceding and current row) as cum_balance,
                                (select sum(greatest(c_acctbal, 0)) from customer) as total
                         from customer)
              select c_custkey, c_acctbal, cum_balance from c
              where cum_balance - greatest(c_acctbal, 0) < 0.5 * total""",
       doubles=("c_acctbal", "cum_balance"))
def q_prefix_until_target(spark, sf_dir):
    """Customers in descending balance order until half of the positive
    balance is covered (the row that crosses the target is included)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    owed = F.greatest(F.col("c_acctbal"), F.lit(0.0))  # debts neither count nor take away
    total = c.agg(F.sum(owed)).first()[0] or 0.0
    cum = ordered_prefix_sums(c, [F.col("c_acctbal").desc(), F.col("c_custkey")],
                              {"cum_balance": owed})
    return cum.where(F.col("cum_balance") - owed < F.lit(0.5 * total)).select(
        "c_custkey", "c_acctbal", "cum_balance")


@query("order_by_mixed",
       sql="""select c_mktsegment, c_nationkey, count(*) as n, sum(c_acctbal) as balance from customer
              group by 1, 2 order by c_mktsegment asc, balance desc""",
       doubles=("balance",), longs=("c_nationkey",))
def q_order_by_mixed(spark, sf_dir):
    """multi-key ascending / descending order."""
    c = read_table(spark, sf_dir, "customer")
    return c.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"),
                                                         F.sum("c_acctbal").alias("balance")) \
        .orderBy(F.col("c_mktsegment").asc(), F.col("balance").desc())
