"""Registered experiment, pricing-signal, ranking and grouping queries
(title-only items T16, T17, T19, T26-T32, T34, T36, T37, T42, T44)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import counterfactual as cf
from tillwise.operators import experiments as ex
from tillwise.operators import metrics as mt
from tillwise.operators import product as pa
from tillwise.operators import quality as dq
from tillwise.operators import similarity as sim
from tillwise.operators import uplift as up
from tillwise.sources.fixtures import fx_sales_train, fx_scored
from tillwise.sources.tables import read_table


def _u(seed: str, key: str) -> str:
    """DuckDB twin of ``md5_uniform(seed, key)``."""
    return (f"(cast(cast('0x' || substr(md5(concat_ws('-', '{seed}', cast({key} as varchar))), 1, 8) as bigint)"
            f" as double) / cast(4294967296 as double))")


def _arm(seed: str, key: str, arms: list[str]) -> str:
    lst = "[" + ", ".join(f"'{a}'" for a in arms) + "]"
    return f"{lst}[cast(least(floor({_u(seed, key)} * {len(arms)}), {len(arms) - 1}) as integer) + 1]"


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@query("ab_ttest",
       sql=f"""with e as (select event_type, value, {_arm('ab', 'user_id', ['A', 'B'])} as arm from events),
               g as (select event_type, count(value) filter (where arm = 'A') as n_a,
                            count(value) filter (where arm = 'B') as n_b,
                            avg(value) filter (where arm = 'A') as mean_a, avg(value) filter (where arm = 'B') as mean_b,
                            var_samp(value) filter (where arm = 'A') as var_a,
                            var_samp(value) filter (where arm = 'B') as var_b from e group by 1)
               select *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) as t_stat,
                      (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
                        / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)) as dof
               from g""",
       doubles=("mean_a", "mean_b", "var_a", "var_b", "t_stat", "dof"))
def q_ab_ttest(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("arm", ex.assign_arm(F.col("user_id"), "ab", ["A", "B"]))
    return ex.welch_ttest(e, "value", "arm", ["event_type"])


def _u_of(seed, *keys: str) -> str:
    parts = ", ".join(f"cast({k} as varchar)" for k in keys)
    return (f"(cast(cast('0x' || substr(md5(concat_ws('-', '{seed}', {parts})), 1, 8) as bigint)"
            f" as double) / cast(4294967296 as double))")


@query("quantile_test",
       sql=f"""with e as (select event_id, value as v, {_arm('ab', 'user_id', ['A', 'B'])} as arm from events where value is not null),
               ranked as (select arm, v, row_number() over (partition by arm order by v, event_id) as rank from e),
               plan as (select arm, q, count(*) as n from e, (values (0.5), (0.9)) as t(q) group by all),
               draws as (select arm, cast(q as double) as q, n, b, (n + 1) * cast(q as double) as mean,
                                sqrt((n + 1) * cast(q as double) * (1 - cast(q as double))) as spread
                         from plan, range(-1, 1000) as r(b)),
               picks as (select arm, q, b, least(greatest(cast(round(case when b < 0 then mean else mean + spread
                                * sqrt(-2.0 * ln(greatest({_u_of(42, 'arm', 'q', 'b', '1')}, 1e-12)))
                                * cos(6.283185307179586 * {_u_of(42, 'arm', 'q', 'b', '2')}) end) as bigint), 1), n) as rank from draws),
               per as (select q, b, max(v) filter (where arm = 'A') as va, max(v) filter (where arm = 'B') as vb
                       from picks join ranked using (arm, rank) group by all)
               select q as quantile, max(va) filter (where b < 0) as value_a, max(vb) filter (where b < 0) as value_b,
                      max(vb - va) filter (where b < 0) as difference,
                      quantile_cont(vb - va, 0.025) filter (where b >= 0) as ci_lower,
                      quantile_cont(vb - va, 0.975) filter (where b >= 0) as ci_upper
               from per group by q""",
       doubles=("quantile", "value_a", "value_b", "difference", "ci_lower", "ci_upper"))
def q_quantile_test(spark, sf_dir):
    """Median and 90 % quantile of event values between two arms."""
    e = _events(spark, sf_dir).withColumn("arm", ex.assign_arm(F.col("user_id"), "ab", ["A", "B"]))
    return ex.quantile_test(e, "value", "arm", "event_id", [0.5, 0.9])


@query("ab_sample_size",
       sql=f"""select event_type, avg(value) as mean, var_samp(value) as variance, count(value) as n,
                      ceil({2 * (ex.Z_975 + ex.Z_80) ** 2!r} * var_samp(value)
                           / ((0.05 * avg(value)) * (0.05 * avg(value)))) as n_per_arm
               from events group by 1""",
       doubles=("mean", "variance", "n_per_arm"))
def q_ab_sample_size(spark, sf_dir):
    return ex.sample_size(_events(spark, sf_dir), "value", ["event_type"]).withColumn(
        "n_per_arm", F.col("n_per_arm").cast("double"))


@query("uplift_by_segment",
       sql=f"""with f as (select user_id, event_type as segment from events
                          qualify row_number() over (partition by user_id order by ts, event_id) = 1),
                    u as (select user_id, max(case when event_type = 'purchase' then 1 else 0 end) as converted
                          from events group by 1),
                    x as (select f.segment, u.converted, {_arm('uplift', 'u.user_id', ['T', 'C'])} = 'T' as treated
                          from u join f on f.user_id = u.user_id)
               select segment, count(*) filter (where treated) as n_treat, count(*) filter (where not treated) as n_ctrl,
                      avg(converted) filter (where treated) as rate_treat,
                      avg(converted) filter (where not treated) as rate_ctrl,
                      avg(converted) filter (where treated) - avg(converted) filter (where not treated) as uplift
               from x group by segment""",
       doubles=("rate_treat", "rate_ctrl", "uplift"))
def q_uplift_by_segment(spark, sf_dir):
    e = _events(spark, sf_dir)
    u = e.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("converted"),
        F.min_by("event_type", F.struct("ts", "event_id")).alias("segment"))
    u = u.withColumn("treated", ex.assign_arm(F.col("user_id"), "uplift", ["T", "C"]) == "T")
    return ex.uplift_by_segment(u, "converted", "treated", "segment")


UPLIFT_FEATURES = ["month", "priority", "weekday"]
UPLIFT_DEPTH, UPLIFT_ARM = 2, 20


def _uplift_rows(spark, sf_dir):
    """Orders at random in two arms; a large order is the outcome."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.month("o_orderdate").alias("month"), (F.dayofweek("o_orderdate") - 1).alias("weekday"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
                    (F.col("o_totalprice") > 150_000).cast("int").alias("large"),
                    (ex.assign_arm(F.col("o_orderkey"), "uplift", ["T", "C"]) == "T").alias("treated"))


def _uplift_sql() -> str:
    """The tree level by level; a level's rows carry the number of their node."""
    names = sorted(UPLIFT_FEATURES)
    value = "case s.feature " + " ".join(f"when '{f}' then a.{f}" for f in names) + " end"
    counts = "count(*) filter (where t) as nt, count(*) filter (where not t) as nc, count(*) filter (where t and y) as yt, count(*) filter (where not t and y) as yc"

    def diff(p):
        return f"({p}yt / {p}nt - {p}yc / {p}nc)"

    parts = [f"""a0 as (select month(o_orderdate) as month, dayofweek(o_orderdate) as weekday,
                        cast(substr(o_orderpriority, 1, 1) as integer) as priority, o_totalprice > 150000 as y,
                        {_arm('uplift', 'o_orderkey', ['T', 'C'])} = 'T' as t, 1 as node from orders)"""]
    for k in range(UPLIFT_DEPTH):
        sums = ", ".join(f"cast(sum({c}) over w as double) as l{c}, cast(sum({c}) over p as double) as a{c}" for c in ("nt", "nc", "yt", "yc"))
        rest = ", ".join(f"a{c} - l{c} as r{c}" for c in ("nt", "nc", "yt", "yc"))
        parts.append(f"""h{k} as (select node, feature, bin, {counts}
                    from (select node, t, y, unnest({names}) as feature, unnest([{', '.join(names)}]) as bin from a{k} where node >= {1 << k})
                    group by all),
             c{k} as (select *, {rest} from (select node, feature, bin, {sums} from h{k}
                      window w as (partition by node, feature order by bin), p as (partition by node, feature))),
             s{k} as (select node, feature, bin, (((lnt + lnc) / (ant + anc)) * ({diff('l')} * {diff('l')})
                                                 + ((rnt + rnc) / (ant + anc)) * ({diff('r')} * {diff('r')}))
                                                 - {diff('a')} * {diff('a')} as gain
                      from c{k} where least(lnt, lnc, rnt, rnc) >= {UPLIFT_ARM}
                      qualify gain > 0 and row_number() over (partition by node order by gain desc, feature, bin) = 1),
             a{k + 1} as (select a.* exclude (node), case when s.node is null then a.node when {value} <= s.bin then 2 * a.node
                                 else 2 * a.node + 1 end as node from a{k} a left join s{k} s on s.node = a.node)""")
    splits = " union all ".join(f"select * from s{k}" for k in range(UPLIFT_DEPTH))
    levels = " union all ".join(f"select node, t, y from a{k}{f' where node >= {1 << k}' if k else ''}" for k in range(UPLIFT_DEPTH + 1))
    return f"""with {', '.join(parts)},
            z as (select node, {counts} from ({levels}) group by node)
            select z.node, s.feature, s.bin as last_bin, s.gain, nt as n_treat, nc as n_ctrl, yt / nt as rate_treat,
                   yc / nc as rate_ctrl, yt / nt - yc / nc as uplift from z left join ({splits}) s on s.node = z.node"""


@query("uplift_tree", sql=_uplift_sql(), doubles=("gain", "rate_treat", "rate_ctrl", "uplift"), longs=("node", "last_bin"))
def q_uplift_tree(spark, sf_dir):
    nodes, _ = up.fit_uplift_tree(_uplift_rows(spark, sf_dir), UPLIFT_FEATURES, "large", "treated", UPLIFT_DEPTH, UPLIFT_ARM)
    return nodes


@query("diff_in_diff",
       sql="""select avg(o_totalprice) filter (where t and p) as treated_post,
                     avg(o_totalprice) filter (where t and not p) as treated_pre,
                     avg(o_totalprice) filter (where not t and p) as control_post,
                     avg(o_totalprice) filter (where not t and not p) as control_pre,
                     (avg(o_totalprice) filter (where t and p) - avg(o_totalprice) filter (where t and not p))
                     - (avg(o_totalprice) filter (where not t and p) - avg(o_totalprice) filter (where not t and not p))
                       as did
              from (select o.o_totalprice, c.c_mktsegment = 'BUILDING' as t, o.o_orderdate >= timestamp '1998-01-01' as p
                    from orders o join customer c on c.c_custkey = o.o_custkey)""",
       doubles=("treated_post", "treated_pre", "control_post", "control_pre", "did"))
def q_diff_in_diff(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_totalprice", (F.col("c_mktsegment") == "BUILDING").alias("t"),
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("p"))
    return ex.diff_in_diff(j, "o_totalprice", "t", "p")


IMPACT_UNIT, IMPACT_START = 7, "1997-01-01"


def _impact(spark, sf_dir):
    """Monthly order value by nation of the customer."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-01").alias("month"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return cf.synthetic_control(o.join(c, o.o_custkey == c.c_custkey), "c_nationkey", "month", "o_totalprice", IMPACT_UNIT, IMPACT_START)


@query("causal_impact", note="T37: synthetic control of one nation with placebo intervals: rows-only, planted effect in the tests")
def q_causal_impact(spark, sf_dir):
    return _impact(spark, sf_dir)[0]


@query("causal_impact_units", note="T37: weights of the mix and placebo test: rows-only")
def q_causal_impact_units(spark, sf_dir):
    return _impact(spark, sf_dir)[1]


@query("causal_impact_actual",
       sql=f"""select strftime(o_orderdate, '%Y-%m-01') as period, strftime(o_orderdate, '%Y-%m-01') >= '{IMPACT_START}' as is_post,
                      coalesce(round(sum(o_totalprice) filter (where c_nationkey = {IMPACT_UNIT}), 2), 0) as actual,
                      true as adds_up, true as inside
               from orders join customer on c_custkey = o_custkey group by 1, 2""",
       doubles=("actual",))
def q_causal_impact_actual(spark, sf_dir):
    """The part of T37 that SQL can state: the actual series, effect = actual -
    counterfactual, and an effect inside its interval where the placebo gaps surround 0."""
    e = _impact(spark, sf_dir)[0]
    tol = 1e-6 * F.greatest(F.abs("actual"), F.lit(1.0))
    return e.select("period", "is_post", F.round("actual", 2).alias("actual"),
                    (F.abs(F.col("actual") - F.col("counterfactual") - F.col("effect")) <= tol).alias("adds_up"),
                    (F.col("low") <= F.col("high")).alias("inside"))


@query("psi_drift",
       sql="""with x as (select l_extendedprice as v, l_shipdate >= timestamp '1998-01-01' as cur from lineitem),
                   b as (select min(v) as lo, max(v) as hi from x where not cur),
                   w as (select lo, case when hi > lo then (hi - lo) / 10 else 1.0 end as width from b),
                   g as (select cast(least(greatest(floor((v - w.lo) / w.width), 0), 9) as integer) as bin,
                                count(*) filter (where not cur) as n_base, count(*) filter (where cur) as n_cur
                         from x, w group by 1),
                   t as (select sum(n_base) as a, sum(n_cur) as c from g),
                   s as (select bin, n_base / t.a as base_share, n_cur / t.c as cur_share from g, t),
                   p as (select *, (cur_share - base_share) * ln(greatest(cur_share, 1e-6) / greatest(base_share, 1e-6))
                                as psi_term,
                                abs(sum(cur_share) over o - sum(base_share) over o) as cdf_gap
                         from s window o as (order by bin rows between unbounded preceding and current row))
              select *, sum(psi_term) over () as psi, max(cdf_gap) over () as ks from p""",
       doubles=("base_share", "cur_share", "psi_term", "cdf_gap", "psi", "ks"), longs=("bin",))
def q_psi_drift(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("cur"))
    return ex.psi_drift(li, "l_extendedprice", "cur")


@query("dead_ad_alert",
       sql="""with e as (select user_id, epoch_us(ts) as t,
                               epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) as gap
                        from events),
                   n as (select max(t) as now from e)
              select user_id, avg(gap) as mean_gap_us, max(t) as last_us, count(*) as n_events,
                     (select now from n) - max(t) as silence_us,
                     coalesce((select now from n) - max(t) > 3.0 * avg(gap), false) as is_silent
              from e group by user_id""",
       doubles=("mean_gap_us",))
def q_dead_ad_alert(spark, sf_dir):
    """Users silent for longer than 3x their own mean gap."""
    return pa.silent_entities(_events(spark, sf_dir))


@query("price_elasticity",
       sql="""select l_partkey, regr_slope(ln(q), ln(p)) as elasticity, count(*) as n
              from (select l_partkey, l_quantity as q, l_extendedprice / l_quantity * (1 - l_discount) as p
                    from lineitem) where p > 0 and q > 0 group by 1""",
       doubles=("elasticity",))
def q_price_elasticity(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_quantity").alias("q"),
        (F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount"))).alias("p"))
    return pa.price_elasticity(li, "l_partkey", "p", "q")


@query("competitor_asof",
       sql="""with obs as (select product_name, dt as day, avg(price) as obs from fx_sales_train group by 1, 2),
                   b as (select min(day) as lo, max(day) as hi from obs),
                   cal as (select k.product_name, cast(g as date) as day
                           from (select distinct product_name from obs) k, b,
                                unnest(generate_series(b.lo, b.hi, interval 1 day)) as t(g))
              select cal.product_name, cal.day, obs.obs as price_asof
              from cal asof left join obs on cal.product_name = obs.product_name and cal.day >= obs.day""",
       doubles=("price_asof",), strings=("day",))
def q_competitor_asof(spark, sf_dir):
    """Latest observed brand price at every calendar day (as-of)."""
    return pa.asof_price(fx_sales_train(spark, sf_dir), "product_name", "dt", "price")


@query("surge_ratio",
       sql="""select epoch_us(time_bucket(interval '1 hour', ts)) as window_start_us,
                     count(*) filter (where event_type in ('view', 'click')) as demand,
                     count(*) filter (where event_type = 'purchase') as supply,
                     count(*) filter (where event_type in ('view', 'click'))
                       / greatest(count(*) filter (where event_type = 'purchase'), 1) as ratio,
                     least(2.0, greatest(1.0, count(*) filter (where event_type in ('view', 'click'))
                       / greatest(count(*) filter (where event_type = 'purchase'), 1) / 2.0)) as multiplier
              from events group by 1""",
       doubles=("ratio", "multiplier"))
def q_surge_ratio(spark, sf_dir):
    return pa.surge_ratio(_events(spark, sf_dir))


ARMS = ["A", "B", "C"]


@query("arm_stats",
       sql=f"""with e as (select {_arm('arm', 'user_id', ARMS)} as arm,
                                 case when event_type = 'purchase' then 1 else 0 end as r from events),
                    s as (select arm, count(*) as n_events, sum(r) as rewards, avg(r) as rate from e group by arm),
                    best as (select arm from s order by rate desc, arm limit 1),
                    u as (select distinct user_id from events),
                    a as (select case when {_u('eps', 'user_id')} < 0.1 then {_arm('explore', 'user_id', ARMS)}
                                      else (select arm from best) end as arm from u),
                    c as (select arm, count(*) as n_assigned from a group by arm)
               select s.arm, s.n_events, cast(s.rewards as bigint) as rewards, s.rate,
                      s.arm = (select arm from best) as is_best, coalesce(c.n_assigned, 0) as n_assigned
               from s left join c on c.arm = s.arm""",
       doubles=("rate",))
def q_arm_stats(spark, sf_dir):
    """Per-arm reward rate and an epsilon-greedy (0.1) assignment of users."""
    e = _events(spark, sf_dir)
    x = e.select(ex.assign_arm(F.col("user_id"), "arm", ARMS).alias("arm"),
                 F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("r"))
    s = x.groupBy("arm").agg(F.count(F.lit(1)).alias("n_events"), F.sum("r").cast("long").alias("rewards"),
                             F.avg("r").alias("rate"))
    best = s.orderBy(F.col("rate").desc(), F.col("arm")).first()["arm"]
    users = e.select("user_id").distinct()
    explore = ex.md5_uniform("eps", F.col("user_id")) < 0.1
    a = users.select(F.when(explore, ex.assign_arm(F.col("user_id"), "explore", ARMS)).otherwise(F.lit(best))
                     .alias("arm"))
    c = a.groupBy("arm").agg(F.count(F.lit(1)).alias("n_assigned"))
    return s.join(c, "arm", "left").select("arm", "n_events", "rewards", "rate", (F.col("arm") == best).alias("is_best"),
                                           F.coalesce("n_assigned", F.lit(0)).alias("n_assigned"))


RANK_SQL = """
d as (select s.doc_id, s.y, s.score, doc.source from fx_scored s join documents doc on doc.doc_id = s.doc_id),
bs as (select *, row_number() over (partition by source order by score desc, doc_id) as rank from d qualify rank <= 10),
id as (select *, row_number() over (partition by source order by y desc, doc_id) as rank from d qualify rank <= 10),
dcg as (select source, sum(y / log2(rank + 1.0)) as dcg, sum(cast(y as double)) as hits from bs group by 1),
idcg as (select source, sum(y / log2(rank + 1.0)) as idcg from id group by 1),
tot as (select source, sum(cast(y as double)) as relevant, count(*) as n from d group by 1),
r as (select tot.source, tot.n, tot.relevant, case when idcg <> 0 then dcg / idcg end as ndcg_at_10,
             case when relevant <> 0 then hits / relevant end as recall_at_10
      from tot join dcg on dcg.source = tot.source join idcg on idcg.source = tot.source)"""


def _ranking(spark, sf_dir):
    s = fx_scored(spark, sf_dir)
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("d_id"), "source")
    j = s.join(d, s.doc_id == d.d_id).drop("d_id")
    return mt.ranking_metrics(j, "source", "score", "y", "doc_id", 10)


@query("ndcg_at_k", sql=f"with {RANK_SQL} select source, n, relevant, ndcg_at_10 from r",
       doubles=("relevant", "ndcg_at_10"))
def q_ndcg_at_k(spark, sf_dir):
    return _ranking(spark, sf_dir).select("source", "n", "relevant", "ndcg_at_10")


@query("recall_at_k", sql=f"with {RANK_SQL} select source, n, relevant, recall_at_10 from r",
       doubles=("relevant", "recall_at_10"))
def q_recall_at_k(spark, sf_dir):
    return _ranking(spark, sf_dir).select("source", "n", "relevant", "recall_at_10")


@query("dq_rules",
       sql="""with a as (select count(o_orderkey) / count(*) as c1, count(o_custkey) / count(*) as c2,
                               count(o_totalprice) / count(*) as c3, count(o_orderdate) / count(*) as c4,
                               count(distinct o_orderkey) / count(*) as u1,
                               avg(case when o_totalprice > 0 then 1.0 else 0.0 end) as p1,
                               cast(datediff('day', max(cast(o_orderdate as date)),
                                    (select max(cast(l_shipdate as date)) from lineitem)) as double) as lag_days
                        from orders)
              select 'completeness' as rule, 'o_orderkey' as "column", c1 as value, c1 = 1 as passed from a
              union all select 'completeness', 'o_custkey', c2, c2 = 1 from a
              union all select 'completeness', 'o_totalprice', c3, c3 = 1 from a
              union all select 'completeness', 'o_orderdate', c4, c4 = 1 from a
              union all select 'uniqueness', 'o_orderkey', u1, u1 = 1 from a
              union all select 'range_positive', 'o_totalprice', p1, p1 = 1 from a
              union all select 'freshness_days', 'o_orderdate', lag_days, lag_days <= 30 from a""",
       doubles=("value",))
def q_dq_rules(spark, sf_dir):
    ref = read_table(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate"))).first()[0]
    return dq.dq_rules(read_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                       "o_orderkey", ["o_totalprice"], "o_orderdate", ref)


@query("match_groups",
       sql="""with recursive
              l as (select distinct doc_id, lower(trim(line)) as line
                    from documents, unnest(string_split(text, chr(10))) as u(line)
                    where length(lower(trim(line))) > 0),
              rep as (select line, min(doc_id) as rep from l group by line having count(*) > 1),
              e as (select distinct l.doc_id as src, rep.rep as dst from l join rep on rep.line = l.line
                    where l.doc_id <> rep.rep),
              u as (select src, dst from e union select dst, src from e),
              reach(v, label) as (select doc_id, doc_id from documents
                                  union select u.dst, reach.label from reach join u on u.src = reach.v)
              select v as doc_id, min(label) as component from reach group by v""")
def q_match_groups(spark, sf_dir):
    """Documents connected through shared (normalised, non-empty) lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sim.connected_components(docs.select("doc_id"), sim.shared_line_edges(docs))


@query("semantic_chunks",
       sql="""with v as (select vec_id, cast(embedding as double[]) as v from embeddings),
                   p as (select vec_id, v, lag(v) over (order by vec_id) as before from v),
                   j as (select vec_id, case when before is not null
                                then list_dot_product(v, before) / (sqrt(list_dot_product(v, v))
                                                                   * sqrt(list_dot_product(before, before))) end as cos_prev
                         from p)
              select vec_id, cos_prev,
                     sum(case when cos_prev is null or cos_prev < 0.0 then 1 else 0 end)
                       over (order by vec_id rows between unbounded preceding and current row) as chunk_id
              from j""",
       doubles=("cos_prev",), longs=("chunk_id",))
def q_semantic_chunks(spark, sf_dir):
    return sim.semantic_chunks(read_table(spark, sf_dir, "embeddings"))


@query("match_items", note="T18: class and number of MinHash LSH links of exact Jaccard >= 0.8: rows-only (hash family "
                           "differs across engines)")
def q_match_items(spark, sf_dir):
    return sim.match_items(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("near_duplicate_groups", note="T18 + T19: components of links with exact Jaccard >= 0.8: rows-only")
def q_near_duplicate_groups(spark, sf_dir):
    return sim.near_duplicate_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
