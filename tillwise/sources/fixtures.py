"""Derived input views over the driver tables (FIXTURES.md section 2).

Each function maps the TPC-H-like tables onto the input shape one family of
operators expects. All are lazy DataFrames; column pruning and filters reach
the parquet scans. Dimension tables whose size is fixed by definition
(``nation``: 25 rows, literal value lists) are broadcast; everything else is
left to AQE, which broadcasts only after measuring the runtime size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.sources.tables import Tables


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def fx_activity(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir).events
    return ev.select("user_id", "ts", F.to_date("ts").alias("day"), "event_type", "value")


def fx_employees(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir).customer
    mgr = F.when(F.col("c_custkey") == 0, F.lit(None)).otherwise(
        F.floor((F.col("c_custkey") - 1) / 7).cast("long"))
    return c.select(F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("employee_name"),
                    mgr.alias("manager_id"), F.col("c_acctbal").alias("salary"))


def fx_logs(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir).orders
    # every eighth id is left free, so the log has gaps; every order has its row
    return o.select((F.col("o_orderkey") + F.floor(F.col("o_orderkey") / 7)).cast("long").alias("log_id")).distinct()


def fx_loans(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_acctbal")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    cust = F.col("o_custkey")
    start = F.to_date("o_orderdate")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (20 + cust % 50).cast("int").alias("age"),
        F.col("c_acctbal").alias("income"),
        (cust % 4).cast("int").alias("dependents"),
        (cust % 2).cast("int").alias("has_property"),
        (cust % 3).cast("int").alias("has_car"),
        F.col("o_totalprice").alias("loan_amount"),
        start.alias("loan_start"),
        F.date_add(start, 60).alias("loan_deadline"),
        F.to_date("l_shipdate").alias("loan_payed"))


def fx_sales_train(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    p = t.part.select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_brand").alias("product_name"), F.to_date("l_shipdate").alias("dt"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


def fx_demand_orders(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    return li.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("ts"),
        F.col("l_suppkey").alias("sku_id"),
        F.concat(F.lit("sku-"), F.col("l_suppkey").cast("string")).alias("sku"),
        (10 + F.col("l_suppkey") % 50).cast("double").alias("price"),
        F.col("l_quantity").cast("long").alias("qty"))


def fx_demand_status(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir).orders
    status = (F.when(F.col("o_orderstatus") == "F", "Canceled")
              .when(F.col("o_orderstatus") == "O", "Delivered").otherwise("Shipped"))
    return o.select(F.col("o_orderkey").alias("order_id"), status.alias("status"))


def fx_price_candidates(spark, sf_dir) -> DataFrame:
    p = _t(spark, sf_dir).part.select("p_partkey", "p_type", "p_retailprice")
    # few bytes of parquet hold many parts: dealt by key, no task makes the
    # candidates of a whole file, and what goes by SKU needs no other shuffle
    p = p.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    # five price scenarios per part: a generator, not a join
    p = p.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4))))
    k, key = F.col("k"), F.col("p_partkey")
    scenario = F.when(k < 2, "regular").when(k < 4, "promo").otherwise("competitor_response")
    return p.select(
        key.alias("sku"), F.col("p_type").alias("category"),
        (F.col("p_retailprice") * 80 / 100).alias("cost"),
        (F.col("p_retailprice") * (110 - 10 * k) / 100).alias("price"),
        (20 + (key * 7) % 30 + k * (key % 11 - 2)).cast("long").alias("qty"),
        scenario.alias("scenario_id"))


def fx_candidates_raw(spark, sf_dir) -> DataFrame:
    """Price candidates with rule violations (missing cost, zero price,
    negative quantity) so the quality operators have work to do."""
    c = fx_price_candidates(spark, sf_dir)
    sku = F.col("sku")
    return c.select(
        "sku", "category",
        F.when(sku % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("cost")).alias("cost"),
        F.when(sku % 89 == 0, F.lit(0.0)).otherwise(F.col("price")).alias("price"),
        (F.col("qty") - 25).alias("qty"),
        "scenario_id")


def fx_sku_day(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    d = (t.lineitem.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("sku"))
         .agg(F.sum("l_quantity").cast("long").alias("actual_units")))
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = (d.join(s, d.sku == s.s_suppkey)
         .join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey))
    sku, dom = F.col("sku"), F.dayofmonth("date")
    price = (10 + sku % 50).cast("double")
    return j.select(
        "date", "sku", F.col("n_name").alias("category"), price.alias("price"),
        ((sku * 17 + dom) % 60).cast("long").alias("stock"),
        (price * (F.col("actual_units") + (sku * 13 + dom) % 15)).alias("forecast_gmv"),
        "actual_units")


RESTOCK_PERCENTILES = (5, 10, 25, 50, 75, 90, 95)


def fx_restock(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    # exact percentiles hold one counter per distinct quantity, so a hot part
    # does not grow the aggregation buffer
    q = (t.lineitem.groupBy("l_partkey")
         .agg(F.percentile("l_quantity", [p / 100 for p in RESTOCK_PERCENTILES]).alias("pcts")))
    p = t.part.select("p_partkey", "p_retailprice", "p_size")
    j = q.join(p, q.l_partkey == p.p_partkey)
    pct_map = F.map_from_arrays(F.array(*[F.lit(x) for x in RESTOCK_PERCENTILES]), F.col("pcts"))
    j = j.select(
        F.col("p_partkey").alias("sku_id"), F.col("p_retailprice").alias("price"),
        (F.col("p_retailprice") * 80 / 100).alias("cost"),
        (F.col("p_partkey") % 40).cast("long").alias("current_stock"),
        (2 + F.col("p_size")).cast("long").alias("storage_time"),
        pct_map.alias("pm"))
    j = j.withColumn("weeks", F.explode(F.sequence(F.lit(1), F.lit(4))))
    j = j.select("*", F.explode("pm").alias("percentile", "qv"))
    return j.select(
        "sku_id", "weeks", "percentile", "price", "cost", "current_stock", "storage_time",
        (F.col("weeks") * F.floor("qv")).cast("long").alias("demand"))


def fx_delivery(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    m = F.col("l_suppkey") % 3
    mp = F.when(m == 0, "Ozz").when(m == 1, "WB").otherwise("YM")
    g = li.groupBy(F.col("l_partkey").alias("product"), mp.alias("marketplace")).agg(
        F.percentile("l_quantity", [0.25, 0.75]).alias("q"))
    pk = F.col("product")
    return g.select(
        "product", "marketplace",
        F.floor(F.col("q")[0]).cast("long").alias("min_demand"),
        F.floor(F.col("q")[1]).cast("long").alias("max_demand"),
        (40 + pk % 60).cast("long").alias("stock"), (1 + pk % 3).cast("long").alias("small"),
        (4 + pk % 3).cast("long").alias("middle"), (9 + pk % 4).cast("long").alias("large"))


def fx_inventory(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    # pre-aggregate the fact table before joining the dimension
    sold = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("quantity_sold"))
    p = t.part.select("p_partkey", "p_name", "p_retailprice", "p_size")
    j = sold.join(p, sold.l_partkey == p.p_partkey)
    rp = F.col("p_retailprice")
    return j.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), rp.alias("price"),
        (rp * 80 / 100).alias("cost"), "quantity_sold",
        (F.col("p_size") * rp).alias("inventory_start"),
        ((F.col("p_size") % 7) * rp).alias("inventory_end"))


def fx_forecast_pairs(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    return li.select(
        F.col("l_partkey").alias("sku_id"), F.to_date("l_shipdate").alias("day"),
        F.col("l_returnflag").alias("segment"),
        (10 + F.col("l_suppkey") % 50).cast("double").alias("price"),
        F.col("l_quantity").alias("y"),
        (10 + (F.col("l_partkey") * 3 + F.col("l_linenumber") * 7) % 40).cast("double").alias("p"))


def fx_scored(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    b = t.labels.select("doc_id", "quality")
    d = t.documents.select(F.col("doc_id").alias("d_id"), "n_chars")
    j = b.join(d, b.doc_id == d.d_id)
    return j.select("doc_id", F.col("quality").alias("y"),
                    (F.col("n_chars") % 100 + 20 * F.col("quality")).cast("double").alias("score"))


def fx_predictions(spark, sf_dir) -> DataFrame:
    s = _t(spark, sf_dir).supplier
    k = F.col("s_suppkey")
    return s.select(
        k.alias("sku_id"), ((5 + k % 9).cast("double") / 2).alias("pred_7d_q10"),
        ((20 + k % 17).cast("double") / 2).alias("pred_7d_q50"),
        ((50 + k % 29).cast("double") / 2).alias("pred_7d_q90"),
        (k % 23).cast("long").alias("stock"))


def fx_cold_start(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    miss = (F.col("l_orderkey") + F.col("l_linenumber")) % 5 == 0
    return li.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 50).alias("category"),
                     F.when(miss, F.lit(None).cast("double"))
                     .otherwise(F.col("l_quantity") + 0.25).alias("sales"))


FIXTURES = {f.__name__: f for f in (
    fx_activity, fx_employees, fx_logs, fx_loans, fx_sales_train, fx_demand_orders,
    fx_demand_status, fx_price_candidates, fx_candidates_raw, fx_sku_day, fx_restock,
    fx_delivery, fx_inventory, fx_forecast_pairs, fx_scored, fx_predictions, fx_cold_start)}
