"""Aggregate functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import functions as fn
from tablewright.plans.registry import query, table


@query("agg_any_value", """
select o_custkey, any_value(c_name) as customer_name, count(*) as n_orders
from orders join customer on c_custkey = o_custkey group by o_custkey
""")
def any_value(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return joined.groupBy("o_custkey").agg(
        fn.any_value(F.col("c_name")).alias("customer_name"), F.count(F.lit(1)).alias("n_orders"))


@query("agg_bool_or", "select user_id, bool_or(event_type = 'purchase') as has_bought from events group by user_id")
def bool_or(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(
        fn.bool_or(F.col("event_type") == "purchase").alias("has_bought"))


@query("agg_listagg", """
select o_custkey, string_agg(cast(o_orderkey as varchar), ', ' order by o_orderdate, o_orderkey) as order_list
from orders group by o_custkey
""")
def listagg(spark: SparkSession, sf: str) -> DataFrame:
    return fn.listagg_rows(table(spark, sf, "orders"), "o_custkey", "o_orderkey", "order_list",
                           delimiter=", ", order_by=["o_orderdate", "o_orderkey"])


@query("agg_listagg_distinct", """
select user_id, string_agg(distinct event_type, ',' order by event_type) as event_types from events group by user_id
""")
def listagg_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return fn.listagg_rows(table(spark, sf, "events"), "user_id", "event_type", "event_types", distinct=True)


@query("agg_listagg_nulls", """
select o_custkey, coalesce(string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey)
                           filter (o_orderpriority = '1-URGENT' and o_custkey % 3 <> 0), '') as urgent_orders
from orders group by o_custkey
""")
def listagg_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the customers, at least, has nothing but NULL values."""
    wanted = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 3 != 0)
    orders = table(spark, sf, "orders").withColumn("urgent", F.when(wanted, F.col("o_orderkey")))
    return fn.listagg_rows(orders, "o_custkey", "urgent", "urgent_orders")


@query("agg_listagg_limit", """
select user_id, string_agg(event_type, '_|_' order by ts, event_id) as first_events from (
    select *, row_number() over (partition by user_id order by ts, event_id) as place from events
) where place <= 3 group by user_id
""")
def listagg_limit(spark: SparkSession, sf: str) -> DataFrame:
    return fn.listagg_rows(table(spark, sf, "events"), "user_id", "event_type", "first_events",
                           delimiter="_|_", order_by=["ts", "event_id"], limit=3)
