"""Registered queries on nearest neighbours (T14, T20, T21, L12) and co-purchases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import baskets
from tillwise.operators import metrics as mt
from tillwise.operators import neighbours as nb
from tillwise.plans.model_store import table_model
from tillwise.session import reliable_checkpoint
from tillwise.sources.tables import read_table, table_path

K = 10
GRAPH_SQL = f"""
good as (select vec_id, cast(embedding as double[]) as v from embeddings
         where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
graph as (select q.vec_id as query_id, row_number() over (partition by q.vec_id order by list_distance(q.v, x.v), x.vec_id) as rank,
                 x.vec_id as neighbour_id, list_distance(q.v, x.v) as distance
          from good q join good x on len(q.v) = len(x.v) and q.vec_id <> x.vec_id where q.vec_id % 50 = 0
          qualify rank <= {K})"""


def _graph(spark, sf_dir):
    """The neighbour graph, kept in the model store."""
    rows = read_table(spark, sf_dir, "embeddings")
    return table_model(spark, "neighbour_graph", [table_path(sf_dir, "embeddings")], f"{K}|vec_id % 50",
                       lambda: nb.knn_topk(rows, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)), K))


@query("knn_topk", sql=f"with {GRAPH_SQL} select * from graph", doubles=("distance",), longs=("rank",))
def q_knn_topk(spark, sf_dir):
    """The 10 nearest rows of every row whose id is divisible by 50, against all rows."""
    rows = read_table(spark, sf_dir, "embeddings")
    return nb.knn_topk(rows, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)), K)


@query("similar_item_price",
       sql=f"""with {GRAPH_SQL}
               select query_id, o.p_retailprice as price, sum(p.p_retailprice / (1 + distance)) / sum(1 / (1 + distance)) as similar_price,
                      count(*) as n_priced,
                      o.p_retailprice / nullif(sum(p.p_retailprice / (1 + distance)) / sum(1 / (1 + distance)), 0) as price_ratio
               from graph join part p on p.p_partkey = neighbour_id and p.p_retailprice is not null
               join part o on o.p_partkey = query_id and o.p_retailprice is not null group by query_id, o.p_retailprice""",
       doubles=("price", "similar_price", "price_ratio"))
def q_similar_item_price(spark, sf_dir):
    return nb.similar_item_price(_graph(spark, sf_dir), read_table(spark, sf_dir, "part"), "p_partkey", "p_retailprice")


@query("sku_uniqueness",
       sql=f"""with {GRAPH_SQL},
               m as (select query_id, avg(distance) as uniqueness, count(*) as n_neighbours from graph group by query_id)
               select *, row_number() over (order by uniqueness desc, query_id) as place from m""",
       doubles=("uniqueness",))
def q_sku_uniqueness(spark, sf_dir):
    return nb.sku_uniqueness(_graph(spark, sf_dir))


LOF_FEATURES = ["n_orders", "mean_price", "max_price"]
LOF_K = 20
LOF_SQL = f"""
f as (select o_custkey as id, cast(count(*) as double) as n_orders,
             cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / count(*) / 100000.0 as mean_price, max(o_totalprice) / 1000.0 as max_price
      from orders where o_custkey is not null and o_totalprice is not null group by o_custkey),
train as (select id, [n_orders, mean_price, max_price] as v from f where id % 5 <> 0),
test as (select id, [n_orders, mean_price, max_price] as v from f where id % 5 = 0),
near as (select a.id as q, b.id as o, list_distance(a.v, b.v) as d from train a, train b where a.id <> b.id
         qualify row_number() over (partition by a.id order by d, b.id) <= {LOF_K}),
kd as (select q as id, max(d) as kdist from near group by q),
lrd as (select q as id, 1 / (avg(greatest(d, kdist)) + 1e-10) as lrd from near join kd on kd.id = o group by q),
tnear as (select a.id as q, b.id as o, list_distance(a.v, b.v) as d from test a, train b
          qualify row_number() over (partition by a.id order by d, b.id) <= {LOF_K})
select q as id, avg(lrd) * (avg(greatest(d, kdist)) + 1e-10) as score
from tnear join kd on kd.id = o join lrd on lrd.id = o group by q"""


def _lof(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").where("o_custkey is not null and o_totalprice is not null")
    f = o.groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).cast("double") / F.count(F.lit(1)) / 100000.0).alias("mean_price"),
        (F.max("o_totalprice") / 1000.0).alias("max_price"))
    return nb.lof_scores(f.where("id % 5 <> 0"), f.where("id % 5 = 0"), LOF_FEATURES, LOF_K)


@query("lof_scores", sql=f"with {LOF_SQL}", doubles=("score",))
def q_lof_scores(spark, sf_dir):
    """Customers of the test fifth against the others, by their orders."""
    return _lof(spark, sf_dir)


@query("fraud_report_lof", note="L13 with LOF scores (green by lof_scores and fraud_report): rows-only")
def q_fraud_report_lof(spark, sf_dir):
    late = (read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"))
            .agg(F.max((F.col("o_orderstatus") == "P").cast("int")).alias("y")))
    # the report reads them several times
    scored = reliable_checkpoint(_lof(spark, sf_dir).join(late, "id").withColumn("rid", F.col("id").cast("string")))
    return mt.classification_report(scored, "y", "score")


@query("cart_ranking",
       sql="""with held as (select distinct l_orderkey as basket, l_partkey as item from lineitem where l_orderkey is not null and l_partkey is not null),
              s as (select item, count(*) as n_item from held group by item),
              p as (select a.item as item, b.item as other, count(*) as n_both from held a join held b on a.basket = b.basket and a.item <> b.item
                    group by all having count(*) >= 2),
              l as (select p.*, s.n_item, t.n_item as n_other,
                           n_both * cast((select count(distinct basket) from held) as double) / (s.n_item * t.n_item) as lift
                    from p join s on s.item = p.item join s t on t.item = p.other)
              select item, row_number() over (partition by item order by lift desc, n_both desc, other) as rank, other, n_both, n_item, n_other, lift
              from l qualify rank <= 5""",
       doubles=("lift",), longs=("rank",))
def q_cart_ranking(spark, sf_dir):
    """Per part, the five others of greatest lift among those ordered together at least twice."""
    return baskets.cart_ranking(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
