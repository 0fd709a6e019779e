"""DuckDB text of the derived views (FIXTURES.md section 2), used only by the
oracle side of the correctness check. The Spark side lives in
``tillwise.sources.fixtures`` and is written with the DataFrame API."""

FIXTURE_SQL = {
    "fx_activity": """
select user_id, ts, cast(ts as date) as day, event_type, value from events""",
    "fx_employees": """
select c_custkey as employee_id, c_name as employee_name,
       case when c_custkey = 0 then null else cast(floor((c_custkey - 1) / 7) as bigint) end as manager_id,
       c_acctbal as salary
from customer""",
    "fx_logs": """
select distinct o_orderkey + o_orderkey // 7 as log_id from orders""",
    "fx_loans": """
select l.l_orderkey * 8 + l.l_linenumber as id, cast(20 + o.o_custkey % 50 as int) as age,
       c.c_acctbal as income, cast(o.o_custkey % 4 as int) as dependents,
       cast(o.o_custkey % 2 as int) as has_property, cast(o.o_custkey % 3 as int) as has_car,
       o.o_totalprice as loan_amount, cast(o.o_orderdate as date) as loan_start,
       cast(o.o_orderdate + interval 60 day as date) as loan_deadline,
       cast(l.l_shipdate as date) as loan_payed
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
                join customer c on o.o_custkey = c.c_custkey""",
    "fx_sales_train": """
select p.p_brand as product_name, cast(l.l_shipdate as date) as dt,
       l.l_extendedprice / l.l_quantity as price
from lineitem l join part p on l.l_partkey = p.p_partkey""",
    "fx_demand_orders": """
select l_orderkey as order_id, l_shipdate as ts, l_suppkey as sku_id,
       concat('sku-', cast(l_suppkey as string)) as sku,
       cast(10 + l_suppkey % 50 as double) as price, cast(l_quantity as bigint) as qty
from lineitem""",
    "fx_demand_status": """
select o_orderkey as order_id,
       case o_orderstatus when 'F' then 'Canceled' when 'O' then 'Delivered' else 'Shipped' end as status
from orders""",
    "fx_price_candidates": """
select p_partkey as sku, p_type as category, p_retailprice * 80 / 100 as cost,
       p_retailprice * (110 - 10 * k) / 100 as price,
       cast(20 + (p_partkey * 7) % 30 + k * (p_partkey % 11 - 2) as bigint) as qty,
       case when k < 2 then 'regular' when k < 4 then 'promo' else 'competitor_response' end as scenario_id
from part cross join (values (0), (1), (2), (3), (4)) as t(k)""",
    "fx_candidates_raw": """
select sku, category, case when sku % 97 = 0 then null else cost end as cost,
       case when sku % 89 = 0 then 0.0 else price end as price,
       qty - 25 as qty, scenario_id
from fx_price_candidates""",
    "fx_sku_day": """
select d.date, d.sku, n.n_name as category, cast(10 + d.sku % 50 as double) as price,
       cast((d.sku * 17 + extract(day from d.date)) % 60 as bigint) as stock,
       cast(10 + d.sku % 50 as double) * (d.actual_units + (d.sku * 13 + extract(day from d.date)) % 15) as forecast_gmv,
       d.actual_units
from (select cast(l_shipdate as date) as date, l_suppkey as sku,
             cast(sum(l_quantity) as bigint) as actual_units
      from lineitem group by cast(l_shipdate as date), l_suppkey) d
join supplier s on s.s_suppkey = d.sku join nation n on n.n_nationkey = s.s_nationkey""",
    "fx_restock": """
select q.sku_id, w.weeks, c.percentile, q.price, q.cost, q.current_stock, q.storage_time,
       cast(w.weeks * floor(case c.percentile when 5 then q.p5 when 10 then q.p10 when 25 then q.p25
            when 50 then q.p50 when 75 then q.p75 when 90 then q.p90 else q.p95 end) as bigint) as demand
from (select p.p_partkey as sku_id, p.p_retailprice as price, p.p_retailprice * 80 / 100 as cost,
             cast(p.p_partkey % 40 as bigint) as current_stock, cast(2 + p.p_size as bigint) as storage_time,
             percentile_cont(0.05) within group (order by l.l_quantity) as p5,
             percentile_cont(0.10) within group (order by l.l_quantity) as p10,
             percentile_cont(0.25) within group (order by l.l_quantity) as p25,
             percentile_cont(0.50) within group (order by l.l_quantity) as p50,
             percentile_cont(0.75) within group (order by l.l_quantity) as p75,
             percentile_cont(0.90) within group (order by l.l_quantity) as p90,
             percentile_cont(0.95) within group (order by l.l_quantity) as p95
      from part p join lineitem l on l.l_partkey = p.p_partkey
      group by p.p_partkey, p.p_retailprice, p.p_size) q
cross join (values (1), (2), (3), (4)) as w(weeks)
cross join (values (5), (10), (25), (50), (75), (90), (95)) as c(percentile)""",
    "fx_delivery": """
select l_partkey as product, case l_suppkey % 3 when 0 then 'Ozz' when 1 then 'WB' else 'YM' end as marketplace,
       cast(floor(percentile_cont(0.25) within group (order by l_quantity)) as bigint) as min_demand,
       cast(floor(percentile_cont(0.75) within group (order by l_quantity)) as bigint) as max_demand,
       cast(40 + l_partkey % 60 as bigint) as stock, cast(1 + l_partkey % 3 as bigint) as small,
       cast(4 + l_partkey % 3 as bigint) as middle, cast(9 + l_partkey % 4 as bigint) as large
from lineitem
group by l_partkey, case l_suppkey % 3 when 0 then 'Ozz' when 1 then 'WB' else 'YM' end""",
    "fx_inventory": """
select p.p_partkey as product_id, p.p_name as name, p.p_retailprice as price, p.p_retailprice * 80 / 100 as cost,
       cast(sum(l.l_quantity) as bigint) as quantity_sold,
       p.p_size * p.p_retailprice as inventory_start, (p.p_size % 7) * p.p_retailprice as inventory_end
from part p join lineitem l on l.l_partkey = p.p_partkey
group by p.p_partkey, p.p_name, p.p_retailprice, p.p_size""",
    "fx_forecast_pairs": """
select l_partkey as sku_id, cast(l_shipdate as date) as day, l_returnflag as segment,
       cast(10 + l_suppkey % 50 as double) as price, l_quantity as y,
       cast(10 + (l_partkey * 3 + l_linenumber * 7) % 40 as double) as p
from lineitem""",
    "fx_scored": """
select b.doc_id, b.quality as y, cast(d.n_chars % 100 + 20 * b.quality as double) as score
from labels b join documents d on d.doc_id = b.doc_id""",
    "fx_predictions": """
select s_suppkey as sku_id, cast(5 + s_suppkey % 9 as double) / 2 as pred_7d_q10,
       cast(20 + s_suppkey % 17 as double) / 2 as pred_7d_q50,
       cast(50 + s_suppkey % 29 as double) / 2 as pred_7d_q90, cast(s_suppkey % 23 as bigint) as stock
from supplier""",
    "fx_cold_start": """
select l_orderkey, l_linenumber, l_partkey % 50 as category,
       case when (l_orderkey + l_linenumber) % 5 = 0 then null else l_quantity + 0.25e0 end as sales
from lineitem""",
}
