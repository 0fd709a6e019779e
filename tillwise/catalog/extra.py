"""Registered promo-interval, churn-bootstrap and BPE queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import product as pa
from tillwise.operators import text as tx
from tillwise.operators.experiments import bootstrap_mean_ci
from tillwise.sources.tables import read_table

PROMO_SQL = """
promos as (select o_orderkey as promo_id, cast(o_orderdate as date) as s, cast(o_orderdate as date) + 14 as e
           from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F'),
pd as (select promo_id, cast(g as date) as day from promos, unnest(generate_series(s, e, interval 1 day)) as t(g)),
active as (select day, count(*) as n from pd group by day),
f as (select l_orderkey, l_linenumber, l_quantity, cast(l_shipdate as date) as day from lineitem)"""


def _promo(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    promos = o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).select(
        F.col("o_orderkey").alias("promo_id"), F.to_date("o_orderdate").alias("s"),
        F.date_add(F.to_date("o_orderdate"), 14).alias("e"))
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return pa.promo_coverage(li, "l_shipdate", promos, "s", "e", "l_quantity")


@query("promo_join",
       sql=f"""with {PROMO_SQL}
               select f.l_orderkey, f.l_linenumber, coalesce(a.n, 0) as n_active_promos, coalesce(a.n, 0) > 0 as in_promo
               from f left join active a on a.day = f.day""")
def q_promo_join(spark, sf_dir):
    return _promo(spark, sf_dir)[0].select("l_orderkey", "l_linenumber", "n_active_promos", "in_promo")


@query("promo_sales",
       sql=f"""with {PROMO_SQL},
               daily as (select day, sum(l_quantity) as m, count(*) as n from f group by day)
               select pd.promo_id, coalesce(sum(daily.m), 0.0) as l_quantity_in_promo,
                      coalesce(sum(daily.n), 0) as facts_in_promo
               from pd left join daily on daily.day = pd.day group by pd.promo_id""",
       doubles=("l_quantity_in_promo",), longs=("facts_in_promo",))
def q_promo_sales(spark, sf_dir):
    return _promo(spark, sf_dir)[1]


@query("churn_bootstrap",
       sql="""with cm as (select distinct o_custkey, cast(date_trunc('month', o_orderdate) as date) as month from orders),
                   m as (select distinct month from cm),
                   prev as (select m.month, count(distinct a.o_custkey) as active_prev,
                                   count(distinct a.o_custkey) filter (where b.o_custkey is null) as churned
                            from m join cm a on a.month = m.month - interval 1 month
                            left join cm b on b.o_custkey = a.o_custkey and b.month = m.month
                            group by m.month),
                   wk as (select month as day, churned / active_prev as churn_rate from prev),
                   idx as (select row_number() over (order by day) - 1 as i, churn_rate from wk),
                   n as (select count(*) as n from wk),
                   draws as (select r.b, s.j from range(1000) as r(b), n, unnest(range(n.n)) as s(j)),
                   dr as (select draws.b,
                                 floor(cast(cast('0x' || substr(md5(concat_ws('-', '7', cast(draws.b as varchar),
                                       cast(draws.j as varchar))), 1, 8) as bigint) as double)
                                       / cast(4294967296 as double) * n.n) as i
                          from draws, n),
                   per as (select dr.b, avg(idx.churn_rate) as m from dr join idx on idx.i = dr.i group by dr.b)
              select (select avg(churn_rate) from wk) as avg_churn_rate,
                     quantile_cont(m, 0.025) as abs_ci_lower, quantile_cont(m, 0.975) as abs_ci_upper
              from per""",
       doubles=("avg_churn_rate", "abs_ci_lower", "abs_ci_upper"))
def q_churn_bootstrap(spark, sf_dir):
    """Monthly churn rate (customers active last month and not this
    month / active last month), mean with a bootstrap CI over months."""
    o = read_table(spark, sf_dir, "orders")
    cm = o.select("o_custkey", pa.month_of("o_orderdate").alias("month")).distinct()
    months = cm.select("month").distinct()
    a = cm.withColumnRenamed("month", "prev_month")
    cur = months.join(a, F.col("prev_month") == F.add_months(F.col("month"), -1))
    nxt = cm.select("o_custkey", F.col("month").alias("m2"), F.lit(1).alias("_still"))
    j = cur.join(nxt, (cur.o_custkey == nxt.o_custkey) & (F.col("m2") == F.col("month")), "left")
    rate = j.groupBy("month").agg(F.countDistinct(cur.o_custkey).alias("active_prev"),
                                  F.countDistinct(F.when(F.col("_still").isNull(), cur.o_custkey)).alias("churned"))
    rate = rate.select(F.col("month").alias("day"), (F.col("churned") / F.col("active_prev")).alias("churn_rate"))
    r = bootstrap_mean_ci(rate, "churn_rate", None, n_boot=1000, seed=7)
    return r.select(F.col("avg_churn_rate"), "abs_ci_lower", "abs_ci_upper")


BPE_MERGES = 20


def _bpe_sql() -> str:
    """One CTE per merge over the word table; a word is its symbols in angle brackets."""
    tok = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    parts = [f"w0 as materialized (select '<' || array_to_string(string_split(w, ''), '><') || '>' as sym, count(*) as n "
             f"from documents, unnest({tok}) as u(w) group by w)"]
    for k in range(BPE_MERGES):
        parts += [
            f"l{k} as (select string_split(substr(sym, 2, length(sym) - 2), '><') as s, n from w{k})",
            f"b{k} as materialized (select s[i] as a, s[i + 1] as b, cast(sum(n) as bigint) as count "
            f"from l{k}, unnest(range(1, len(s))) as r(i) group by all order by count desc, a, b limit 1)",
            f"w{k + 1} as materialized (select replace(sym, '<' || a || '><' || b || '>', '<' || a || b || '>') as sym, n from w{k}, b{k})"]
    rows = " union all ".join(f"select {k + 1} as rank, a as \"left\", b as \"right\", a || b as merged, count from b{k}" for k in range(BPE_MERGES))
    return f"with {', '.join(parts)} {rows}"


@query("bpe_merges", sql=_bpe_sql(), longs=("rank",))
def q_bpe_merges(spark, sf_dir):
    return tx.bpe_merges(tx.word_counts(read_table(spark, sf_dir, "documents")), n_merges=BPE_MERGES)
