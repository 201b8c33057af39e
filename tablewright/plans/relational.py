"""The relational operators models are made of, and a small project of staged models.

The project follows customers, their orders and the payments on those orders; line items
stand in for payments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.registry import cents, query, table

RETURN_FLAGS = ("A", "N", "R")


def stg_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


def stg_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"))


def stg_payments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("payment_method"),
        cents("l_extendedprice").alias("amount_cents"))


@query("rel_customers", """
with per_order as (
    select l_orderkey, sum(cast(round(l_extendedprice * 100) as bigint)) as amount_cents
    from lineitem group by l_orderkey
), customer_orders as (
    select o_custkey, min(o_orderdate) as first_order, max(o_orderdate) as most_recent_order,
           count(*) as number_of_orders, sum(amount_cents) as total_cents
    from orders left join per_order on l_orderkey = o_orderkey group by o_custkey
)
select c_custkey as customer_id, c_name as customer_name, first_order, most_recent_order, number_of_orders,
       cast(total_cents as bigint) / 100.0::double as customer_lifetime_value
from customer left join customer_orders on o_custkey = c_custkey
""")
def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer with the dates and number of their orders and the sum of payments.

    Payments are added up per order before they meet the orders, and orders per customer before they
    meet the customers, so every join is between sides with one row per key.
    """
    per_order = stg_payments(spark, sf).groupBy("order_id").agg(F.sum("amount_cents").alias("amount_cents"))
    per_customer = (
        stg_orders(spark, sf).join(per_order, "order_id", "left").groupBy("customer_id").agg(
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("most_recent_order"),
            F.count(F.lit(1)).alias("number_of_orders"),
            (F.sum("amount_cents") / 100).alias("customer_lifetime_value"))
    )
    return stg_customers(spark, sf).join(per_customer, "customer_id", "left")


@query("rel_orders_pivot", """
with paid as (
    select l_orderkey, l_returnflag, cast(round(l_extendedprice * 100) as bigint) as amount_cents from lineitem
), per_order as (
    select l_orderkey,
           sum(case when l_returnflag = 'A' then amount_cents else 0 end)::bigint as a_cents,
           sum(case when l_returnflag = 'N' then amount_cents else 0 end)::bigint as n_cents,
           sum(case when l_returnflag = 'R' then amount_cents else 0 end)::bigint as r_cents,
           sum(amount_cents)::bigint as total_cents
    from paid group by l_orderkey
)
select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date, o_orderstatus as status,
       a_cents, n_cents, r_cents, total_cents
from orders left join per_order on l_orderkey = o_orderkey
""")
def orders_pivot(spark: SparkSession, sf: str) -> DataFrame:
    per_order = stg_payments(spark, sf).groupBy("order_id").agg(
        *[F.sum(F.when(F.col("payment_method") == m, F.col("amount_cents")).otherwise(0)).alias(f"{m.lower()}_cents")
          for m in RETURN_FLAGS],
        F.sum("amount_cents").alias("total_cents"))
    return stg_orders(spark, sf).join(per_order, "order_id", "left")


@query("rel_project_rename", """
select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date, o_orderstatus as status
from orders
""")
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return stg_orders(spark, sf)


@query("rel_arith", """
select l_orderkey as order_id, l_returnflag as payment_method,
       cast(round(l_extendedprice * 100) as bigint) / 100.0::double as amount
from lineitem
""")
def arith(spark: SparkSession, sf: str) -> DataFrame:
    return stg_payments(spark, sf).select("order_id", "payment_method", (F.col("amount_cents") / 100).alias("amount"))


@query("rel_filter", """
select o_orderkey, o_orderdate, o_totalprice from orders
where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '2000-01-01' and o_totalprice > 1000
""")
def filtered(spark: SparkSession, sf: str) -> DataFrame:
    at = F.col("o_orderdate")
    return table(spark, sf, "orders").filter(
        (at >= F.lit("1997-01-01").cast("timestamp_ntz")) & (at < F.lit("2000-01-01").cast("timestamp_ntz"))
        & (F.col("o_totalprice") > 1000)
    ).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("rel_inner_join", """
select o_orderkey, c_name, cast(round(o_totalprice * 100) as bigint) as total_cents,
       o_totalprice > c_acctbal as exceeds_balance
from orders join customer on o_custkey = c_custkey
""")
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "inner")
    return joined.select("o_orderkey", "c_name", cents("o_totalprice").alias("total_cents"),
                         (F.col("o_totalprice") > F.col("c_acctbal")).alias("exceeds_balance"))


@query("rel_left_join_multi", """
with every as (select o_custkey, o_orderstatus, count(*) as n_orders from orders group by all),
urgent as (select o_custkey, o_orderstatus, count(*) as n_urgent from orders
           where o_orderpriority = '1-URGENT' group by all)
select every.o_custkey, every.o_orderstatus, n_orders, n_urgent
from every left join urgent on every.o_custkey = urgent.o_custkey and every.o_orderstatus = urgent.o_orderstatus
""")
def left_join_multi(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    keys = ["o_custkey", "o_orderstatus"]
    every = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_urgent"))
    return every.join(urgent, keys, "left")


@query("rel_semi", "select * from customer where c_custkey in (select user_id from events)")
def semi(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    return table(spark, sf, "customer").join(seen, "c_custkey", "left_semi")


@query("rel_anti", """
select * from customer where not exists (select 1 from events where user_id = c_custkey and event_type = 'purchase')
""")
def anti(spark: SparkSession, sf: str) -> DataFrame:
    buyers = table(spark, sf, "events").filter("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey")).distinct()
    return table(spark, sf, "customer").join(buyers, "c_custkey", "left_anti")


@query("rel_having", """
select o_custkey, count(*) as n_orders, max(o_orderdate) as last_order
from orders group by o_custkey having count(*) > 10
""")
def having(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")).filter("n_orders > 10")


@query("rel_distinct", "select distinct l_returnflag, l_linestatus, l_suppkey from lineitem")
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("rel_union_all", """
select o_custkey as customer_id, 'order' as kind from orders
union all select user_id as customer_id, event_type as kind from events
""")
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"), F.lit("order").alias("kind"))
    events = table(spark, sf, "events").select(F.col("event_type").alias("kind"), F.col("user_id").alias("customer_id"))
    return orders.unionByName(events)


@query("rel_except", """
select o_custkey as customer_id from orders except select o_custkey from orders where o_orderpriority = '1-URGENT'
""")
def except_(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"), "o_orderpriority")
    return orders.select("customer_id").subtract(orders.filter("o_orderpriority = '1-URGENT'").select("customer_id"))


@query("rel_intersect", "select o_custkey as customer_id from orders intersect select user_id from events")
def intersect(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id")).intersect(
        table(spark, sf, "events").select(F.col("user_id").alias("customer_id")))
