"""Maintained views on the orders table, refreshed from its changes.

Between its two states the table lost the pending orders from before 1996, had the open orders of
1999 finished at a price one higher, and received the orders placed since 2000.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.naming import TableRef
from tablewright.operators.constraints import Check
from tablewright.operators.views import (
    AggregateView, aggregate_result, change_feed, create_aggregate, materialize_mv, refresh_incremental,
)
from tablewright.plans.incremental import at
from tablewright.plans.registry import cents, query, table
from tablewright.streaming.refresh import stream_refresh
from tablewright.workspace import scratch_namespace, scratch_path


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", cents("o_totalprice").alias("price_cents"))


def state_before(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).filter(F.col("o_orderdate") < at("2000-01-01"))


def state_after(spark: SparkSession, sf: str) -> DataFrame:
    finished = ((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= at("1999-01-01"))
                & (F.col("o_orderdate") < at("2000-01-01")))
    left = _orders(spark, sf).filter(~((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < at("1996-01-01"))))
    return left.withColumn("price_cents", F.col("price_cents") + F.when(finished, 100).otherwise(0)).withColumn(
        "o_orderstatus", F.when(finished, "F").otherwise(F.col("o_orderstatus")))


_ORDERS = """select o_orderkey, o_custkey, o_orderstatus, o_orderdate,
    cast(round(o_totalprice * 100) as bigint) as price_cents from orders"""
_DONE = "o_orderstatus = 'O' and o_orderdate >= timestamp '1999-01-01' and o_orderdate < timestamp '2000-01-01'"
BEFORE = f"select * from ({_ORDERS}) where o_orderdate < timestamp '2000-01-01'"
AFTER = f"""select * replace (case when {_DONE} then price_cents + 100 else price_cents end as price_cents,
    case when {_DONE} then 'F' else o_orderstatus end as o_orderstatus)
    from ({_ORDERS}) where not (o_orderstatus = 'P' and o_orderdate < timestamp '1996-01-01')"""


@query("mv_tier", """
select o_orderkey, o_totalprice, case when o_totalprice >= 200000 then 'high' else 'low' end as tier from orders
""")
def tier(spark: SparkSession, sf: str) -> DataFrame:
    def model() -> DataFrame:
        return table(spark, sf, "orders").select(
            "o_orderkey", "o_totalprice", F.when(F.col("o_totalprice") >= 200000, "high").otherwise("low").alias("tier"))

    return materialize_mv(model, TableRef("order_tiers", scratch_namespace(spark, "mv")), on_demand=True,
                          partitioned_by="tier", comment="orders by size")


@query("mv_totals", f"select o_custkey, sum(price_cents)::bigint as total_cents from ({AFTER}) "
                    "where price_cents > 100000 group by o_custkey")
def totals(spark: SparkSession, sf: str) -> DataFrame:
    """Refreshed in full when its source has changed; small orders are dropped by a constraint."""
    ref = TableRef("customer_totals", scratch_namespace(spark, "mv"))

    def build(orders: DataFrame) -> DataFrame:
        kept = materialize_mv(lambda: orders, ref.sibling("big_orders"), on_demand=True,
                              checks=[Check("price_cents > 100000", "big", "DROP")])
        return materialize_mv(lambda: kept.groupBy("o_custkey").agg(F.sum("price_cents").alias("total_cents")),
                              ref, on_demand=True)

    build(state_before(spark, sf))
    return build(state_after(spark, sf))


@query("change_feed", f"""
with a as ({BEFORE}), b as ({AFTER}),
changed as (select a.o_orderkey from a join b on a.o_orderkey = b.o_orderkey
            where a.price_cents <> b.price_cents or a.o_orderstatus <> b.o_orderstatus)
select *, 'delete' as _change_type from a where o_orderkey not in (select o_orderkey from b)
union all select *, 'insert' from b where o_orderkey not in (select o_orderkey from a)
union all select *, 'update_preimage' from a where o_orderkey in (from changed)
union all select *, 'update_postimage' from b where o_orderkey in (from changed)
""")
def feed(spark: SparkSession, sf: str) -> DataFrame:
    return change_feed(state_before(spark, sf), state_after(spark, sf), "o_orderkey")


TOTALS = AggregateView(["o_custkey", "o_orderstatus"], sums={"total_cents": "price_cents"}, count="n_orders")
SPANS = AggregateView("o_custkey", sums={"total_cents": "price_cents"}, count="n_orders",
                      extremes={"smallest": ("min", "price_cents"), "last_order": ("max", "o_orderdate")})

_TOTALS_SQL = f"""
select o_custkey, o_orderstatus, count(*) as n_orders, sum(price_cents)::bigint as total_cents
from ({AFTER}) group by o_custkey, o_orderstatus
"""


@query("mv_incremental", _TOTALS_SQL)
def incremental(spark: SparkSession, sf: str) -> DataFrame:
    ref = TableRef("totals", scratch_namespace(spark, "mv"))
    create_aggregate(state_before(spark, sf), ref, TOTALS)
    return aggregate_result(refresh_incremental(ref, feed(spark, sf), TOTALS), TOTALS)


@query("mv_incremental_extremes", f"""
select o_custkey, count(*) as n_orders, sum(price_cents)::bigint as total_cents,
       min(price_cents) as smallest, max(o_orderdate) as last_order
from ({AFTER}) group by o_custkey
""")
def extremes(spark: SparkSession, sf: str) -> DataFrame:
    ref = TableRef("spans", scratch_namespace(spark, "mv"))
    create_aggregate(state_before(spark, sf), ref, SPANS)
    return aggregate_result(
        refresh_incremental(ref, feed(spark, sf), SPANS, base=state_after(spark, sf)), SPANS)


@query("mv_incremental_two_streams", _TOTALS_SQL)
def two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds, each with a checkpoint of its own, bring the changes of one half of the customers."""
    ref = TableRef("totals", scratch_namespace(spark, "mv"))
    create_aggregate(state_before(spark, sf), ref, TOTALS)
    changes = feed(spark, sf)
    for half in range(2):
        arriving = scratch_path(spark, "feed")
        changes.filter(F.col("o_orderkey") % 2 == half).write.parquet(arriving)
        state = stream_refresh(spark, arriving, changes.schema, ref, TOTALS, scratch_path(spark, "feed-checkpoint"), new_stream=True)
    return aggregate_result(state, TOTALS)


@query("mv_incremental_stream", _TOTALS_SQL)
def streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The feed arrives as files; a second call on the same checkpoint finds nothing new."""
    ref = TableRef("totals", scratch_namespace(spark, "mv"))
    create_aggregate(state_before(spark, sf), ref, TOTALS)
    arriving, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "feed-checkpoint")
    changes = feed(spark, sf)
    changes.write.parquet(arriving)
    for _ in range(2):
        state = stream_refresh(spark, arriving, changes.schema, ref, TOTALS, checkpoint)
    return aggregate_result(state, TOTALS)
