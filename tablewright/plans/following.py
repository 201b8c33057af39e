"""Views that follow changes: extremes from lists, joins, change logs and the choice of refresh.

Orders change as in ``plans.maintained``.  Of the customers, those with the lowest balances leave, builders are renamed,
and the machinery segment arrives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.naming import TableRef
from tablewright.operators.changelog import changes_between, create_logged, delete_logged, merge_logged, net_changes, update_logged, VERSION
from tablewright.operators.choice import refresh
from tablewright.operators.joins import JoinView, create_join, refresh_join
from tablewright.operators.views import (
    AggregateView, aggregate_result, aggregate_state, apply_changes, change_feed, create_aggregate, refresh_incremental,
)
from tablewright.plans.incremental import at
from tablewright.plans.maintained import _ORDERS, _TOTALS_SQL, AFTER, BEFORE, TOTALS, feed, state_after, state_before
from tablewright.plans.registry import cents, query, table
from tablewright.streaming.refresh import stream_refresh
from tablewright.workspace import scratch_namespace, scratch_path

LISTED = AggregateView("o_custkey", sums={"total_cents": "price_cents"}, count="n_orders", kept=16,
                       extremes={"smallest": ("min", "price_cents"), "last_order": ("max", "o_orderdate")})


@query("mv_stream_extremes", f"""
select o_custkey, count(*) as n_orders, sum(price_cents)::bigint as total_cents,
       min(price_cents) as smallest, max(o_orderdate) as last_order
from ({AFTER}) group by o_custkey
""")
def stream_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds bring deletions and updates; minima and maxima are taken back from the lists of the state."""
    ref = TableRef("spans", scratch_namespace(spark, "mv"))
    create_aggregate(state_before(spark, sf), ref, LISTED)
    changes = feed(spark, sf)
    for early in (True, False):
        arriving = scratch_path(spark, "feed")
        changes.filter((F.col("o_orderdate") < at("1996-01-01")) == early).write.parquet(arriving)
        state = stream_refresh(spark, arriving, changes.schema, ref, LISTED, scratch_path(spark, "feed-checkpoint"), new_stream=True,
                               base=lambda: state_after(spark, sf))
    return aggregate_result(state, LISTED)


# Early pending orders are made so large that beside them the others round away; all of them leave.
_HUGE = "o_orderstatus = 'P' and o_orderdate < timestamp '1996-01-01'"
AMOUNTS = AggregateView("o_custkey", sums={"total": "amount"}, count="n_orders", exact=True)


def _amounts(orders: DataFrame) -> DataFrame:
    early = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < at("1996-01-01"))
    return orders.withColumn("amount", F.col("price_cents") / F.lit(100.0) * F.when(early, F.lit(1e18)).otherwise(F.lit(1.0)))


@query("mv_incremental_float_sums", f"""
select o_custkey, count(*) as n_orders, round(sum(price_cents)::bigint / 100.0, 2) as total
from ({AFTER}) where not ({_HUGE}) group by o_custkey
""")
def float_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of doubles taken back from changes alone, without the base rows."""
    ref = TableRef("amounts", scratch_namespace(spark, "mv"))
    before, after = _amounts(state_before(spark, sf)), _amounts(state_after(spark, sf))
    create_aggregate(before, ref, AMOUNTS)
    state = refresh_incremental(ref, change_feed(before, after, "o_orderkey"), AMOUNTS)
    return aggregate_result(state, AMOUNTS).withColumn("total", F.round("total", 2))


def customers_before(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", cents("c_acctbal").alias("balance_cents")) \
        .filter("c_mktsegment <> 'MACHINERY'")


def customers_after(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", cents("c_acctbal").alias("balance_cents"))
    return rows.filter("balance_cents >= 0").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("c_mktsegment")))


_CUSTOMERS_AFTER = """select c_custkey, case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end as c_mktsegment
    from customer where cast(round(c_acctbal * 100) as bigint) >= 0"""
PLACED = JoinView(on={"o_custkey": "c_custkey"}, key="o_orderkey", columns={
    "o_orderkey": ("left", "o_orderkey"), "c_custkey": ("right", "c_custkey"), "segment": ("right", "c_mktsegment"),
    "o_orderstatus": ("left", "o_orderstatus"), "price_cents": ("left", "price_cents")})


@query("mv_incremental_join", f"""
select o_orderkey, c_custkey, c_mktsegment as segment, o_orderstatus, price_cents
from ({AFTER}) o join ({_CUSTOMERS_AFTER}) c on o.o_custkey = c.c_custkey
""")
def incremental_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customers' segment, kept up to date from the changes of both."""
    ref = TableRef("placed", scratch_namespace(spark, "mv"))
    create_join(state_before(spark, sf), customers_before(spark, sf), ref, PLACED)
    customers = change_feed(customers_before(spark, sf), customers_after(spark, sf), "c_custkey")
    return refresh_join(ref, state_after(spark, sf), feed(spark, sf), customers_after(spark, sf), customers, PLACED)


def _logged(spark: SparkSession, sf: str) -> TableRef:
    ref = TableRef("orders", scratch_namespace(spark, "log"))
    create_logged(state_before(spark, sf), ref, "o_orderkey")
    return ref


def _finish_orders(spark: SparkSession, ref: TableRef) -> None:
    finished = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= at("1999-01-01")) & (F.col("o_orderdate") < at("2000-01-01"))
    update_logged(spark, ref, finished, {"o_orderstatus": F.lit("F"), "price_cents": F.col("price_cents") + 100})


def _change(spark: SparkSession, sf: str, ref: TableRef) -> None:
    """From the state before to the state after, in three versions."""
    _finish_orders(spark, ref)
    merge_logged(ref, state_after(spark, sf).filter(F.col("o_orderdate") >= at("1999-06-01")))
    delete_logged(spark, ref, (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < at("1996-01-01")))


@query("change_log", f"""
with a as ({BEFORE}), b as ({AFTER}),
changed as (select a.o_orderkey from a join b on a.o_orderkey = b.o_orderkey
            where a.price_cents <> b.price_cents or a.o_orderstatus <> b.o_orderstatus)
select *, 'delete' as _change_type from a where o_orderkey not in (select o_orderkey from b)
union all select *, 'insert' from b where o_orderkey not in (select o_orderkey from a)
union all select *, 'update_preimage' from a where o_orderkey in (from changed)
union all select *, 'update_postimage' from b where o_orderkey in (from changed)
""")
def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """What an update, a merge and a deletion left in the log, summed up per key."""
    ref = _logged(spark, sf)
    _change(spark, sf, ref)
    return net_changes(changes_between(spark, ref, 0), "o_orderkey")


@query("change_log_versions", f"""
with o as ({_ORDERS}), done as (select * from ({BEFORE}) where o_orderstatus = 'O' and o_orderdate >= timestamp '1999-01-01')
select 1::bigint as _version, 'update_preimage' as _change_type, count(*) as n_rows, sum(price_cents)::bigint as total_cents from done
union all select 1, 'update_postimage', count(*), sum(price_cents + 100)::bigint from done
union all select 2, 'insert', count(*), sum(price_cents)::bigint from o where o_orderdate >= timestamp '2000-01-01'
union all select 3, 'delete', count(*), sum(price_cents)::bigint from o
    where o_orderstatus = 'P' and o_orderdate < timestamp '1996-01-01' having count(*) > 0
""")
def change_log_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Each version's entry by itself; a merge of rows that are as they were leaves none for them."""
    ref = _logged(spark, sf)
    _change(spark, sf, ref)
    return changes_between(spark, ref, 0).groupBy(VERSION, "_change_type").agg(
        F.count("*").alias("n_rows"), F.sum("price_cents").alias("total_cents"))


@query("mv_refresh_choice", _TOTALS_SQL)
def refresh_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Built in full, skipped, brought up to date from the log, and skipped again."""
    ref = _logged(spark, sf)
    view, took = ref.sibling("totals"), []

    def up_to_date() -> None:
        took.append(refresh(
            spark, view, {"orders": ref}, lambda rows: aggregate_state(rows["orders"], TOTALS),
            lambda state, feeds, rows: apply_changes(state, feeds["orders"], TOTALS)))

    up_to_date()
    up_to_date()
    _change(spark, sf, ref)
    up_to_date()
    up_to_date()
    if took != ["full", "skipped", "incremental", "skipped"]:
        raise RuntimeError(f"the view was refreshed {took}")
    return aggregate_result(spark.table(view.sql), TOTALS)
