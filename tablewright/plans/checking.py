"""Data tests, comparisons, contracts and constraints on tables with known defects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.naming import TableRef
from tablewright.operators import checks
from tablewright.operators.builds import Model, build_increment, build_snapshot, build_view
from tablewright.operators.constraints import Check, contract, enforce, not_null_check
from tablewright.operators.digests import relations_equal_by_ranges as by_ranges
from tablewright.operators.snapshot import SnapshotConfig
from tablewright.plans.registry import cents, query, table
from tablewright.workspace import scratch_namespace

EVENT_TYPES = ["click", "purchase", "view"]


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the segment BUILDING blanked out."""
    return table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))


@query("test_not_null", """
select * replace (cast(null as varchar) as c_mktsegment) from customer where c_mktsegment = 'BUILDING'
""")
def not_null(spark: SparkSession, sf: str) -> DataFrame:
    return checks.not_null(gaps(spark, sf), "c_mktsegment")


@query("test_unique", """
select l_orderkey as unique_field, count(*) as n_records from lineitem group by l_orderkey having count(*) > 1
""")
def unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unique(table(spark, sf, "lineitem"), "l_orderkey")


@query("test_accepted_values", """
select event_type as value_field, count(*) as n_records from events
where event_type not in ('click', 'purchase', 'view') group by event_type
""")
def accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return checks.accepted_values(table(spark, sf, "events"), "event_type", EVENT_TYPES)


@query("test_relationships", """
select o_custkey as from_field from orders where o_custkey not in (select user_id from events)
""")
def relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of customers who never show up in the events."""
    return checks.relationships(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "events"), "user_id")


def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf, "orders").join(lines, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query("test_singular", """
select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
""")
def singular(spark: SparkSession, sf: str) -> DataFrame:
    return orders_without_lines(spark, sf)


@query("test_evaluate", """
with failures(test_name, n) as (
    select 'not_null', count(*) from customer where c_mktsegment = 'BUILDING'
    union all select 'unique', count(*) from (select 1 from customer group by c_custkey having count(*) > 1)
    union all select 'accepted_values', count(distinct event_type) from events
              where event_type not in ('click', 'purchase', 'view')
    union all select 'accepted_rows', sum(n) from (select count(*) as n from events
              where event_type not in ('click', 'purchase', 'view') group by event_type)
    union all select 'relationships', count(*) from orders where o_custkey not in (select user_id from events))
select test_name, cast(n as bigint) as failures, n > 2 as should_warn, n <> 0 as should_error from failures
""")
def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    events = checks.accepted_values(table(spark, sf, "events"), "event_type", EVENT_TYPES)
    results = {
        "not_null": checks.evaluate(not_null(spark, sf), warn_if="> 2"),
        "unique": checks.evaluate(checks.unique(table(spark, sf, "customer"), "c_custkey"), warn_if="> 2"),
        "accepted_values": checks.evaluate(events, warn_if="> 2"),
        "accepted_rows": checks.evaluate(events, fail_calc="sum(n_records)", warn_if="> 2"),
        "relationships": checks.evaluate(relationships(spark, sf), warn_if="> 2"),
    }
    return reduce(DataFrame.unionByName, [
        result.select(F.lit(name).alias("test_name"), "*") for name, result in results.items()])


@query("test_store_failures", """
select l_orderkey as unique_field, count(*) as n_records from lineitem group by l_orderkey having count(*) > 1
""")
def store_failures(spark: SparkSession, sf: str) -> DataFrame:
    return checks.store_failures(unique(spark, sf), TableRef("unique_l_orderkey", scratch_namespace(spark, "audit")))


_EDITED = """select * replace (case when o_orderstatus = 'O' and o_orderdate >= timestamp '1999-01-01' then 'F'
    else o_orderstatus end as o_orderstatus) from orders where o_orderdate < timestamp '2001-07-01'"""


def edited(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with some statuses changed and the last month missing."""
    late = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return table(spark, sf, "orders").filter(
        F.col("o_orderdate") < F.lit("2001-07-01").cast("timestamp_ntz")
    ).withColumn("o_orderstatus", F.when(late, "F").otherwise(F.col("o_orderstatus")))


@query("relations_equal", f"""
with edited as ({_EDITED})
select (select count(*) from orders) - (select count(*) from edited) as row_count_difference,
       (select count(*) from ((select * from orders except select * from edited)
                              union all (select * from edited except select * from orders))) as num_mismatched
""")
def relations_equal(spark: SparkSession, sf: str) -> DataFrame:
    return checks.relations_equal(table(spark, sf, "orders"), edited(spark, sf))


@query("relations_equal_by_ranges", f"""
with edited as ({_EDITED})
select (select count(*) from orders) - (select count(*) from edited) as row_count_difference,
       (select count(*) from ((select * from orders except select * from edited)
                              union all (select * from edited except select * from orders))) as num_mismatched
""")
def relations_equal_by_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The same, row by row only where checksums of key ranges differ."""
    return by_ranges(table(spark, sf, "orders"), edited(spark, sf), key="o_orderkey")


@query("unit_test_diff", f"""
with actual as (select o_custkey, o_orderstatus, count(*) as n_orders from orders group by all),
wanted as (select o_custkey, o_orderstatus, count(*) as n_orders from ({_EDITED}) group by all)
select 'actual' as only_in, count(*) as copies, o_custkey, o_orderstatus, n_orders
from (select * from actual except all select * from wanted) group by all
union all select 'expected', count(*), o_custkey, o_orderstatus, n_orders
from (select * from wanted except all select * from actual) group by all
""")
def unit_test_diff(spark: SparkSession, sf: str) -> DataFrame:
    """A counting model is given the orders and expected to count the edited ones."""
    def model(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))

    return checks.unit_test(model, {"orders": table(spark, sf, "orders")}, model(edited(spark, sf)))


@query("contract_reorder", "select o_orderdate, o_orderkey, o_orderstatus from orders")
def contract_reorder(spark: SparkSession, sf: str) -> DataFrame:
    model = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate")
    return contract(model, "o_orderdate timestamp_ntz, o_orderkey bigint, o_orderstatus string")


@query("constraint_fail_ok", "select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem")
def constraint_fail_ok(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return enforce(rows, [Check("l_quantity > 0", "positive_quantity"), Check("l_discount between 0 and 1"),
                          not_null_check("l_orderkey")])


@query("constraint_drop", """
select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity > 10
""")
def constraint_drop(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return enforce(rows, [Check("l_quantity > 10", "bulk", "DROP"), Check("l_linenumber > 0", "numbered")])


@query("build_with_contract", """
select o_orderkey, o_orderstatus, cast(round(o_totalprice * 100) as bigint) as price_cents,
       md5(cast(o_orderkey as varchar) || '|' || cast(o_orderdate as varchar)) as scd_id,
       o_orderdate as scd_updated_at, o_orderdate as scd_valid_from, cast(null as timestamp) as scd_valid_to, o_orderdate
from orders where o_totalprice > 1000
""")
def build_with_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as an incremental table under a contract, with constraints and data tests, read by a view and kept as history."""
    ns = scratch_namespace(spark, "build")
    shape = "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, price_cents bigint"
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    source = table(spark, sf, "orders").select("o_orderdate", "o_orderstatus", "o_orderkey", cents("o_totalprice").alias("price_cents"))
    orders = Model(TableRef("priced_orders", ns), shape, [Check("price_cents > 100000", "large", "DROP"), not_null_check("o_orderkey")],
                   {"one row per order": lambda rows: checks.unique(rows, "o_orderkey")}, "orders worth following",
                   {"price_cents": "the price in cents"})
    for _ in range(2):  # the first run has all years, the second brings the late ones again
        build_increment(spark, orders, lambda again: source.filter(late) if again else source, strategy="merge", unique_key="o_orderkey")
    seen = Model(TableRef("seen_orders", ns), shape, [Check("price_cents > 0", "positive")], sources=[orders.ref])
    build_view(spark, seen, f"SELECT price_cents, o_orderdate, o_orderkey, o_orderstatus FROM {orders.table.sql}")
    history = Model(TableRef("orders_history", ns), shape, tests={"keys": lambda rows: checks.not_null(rows, "scd_id")}, sources=[seen.ref])
    return build_snapshot(spark, history, lambda: spark.table(seen.table.sql),
                          SnapshotConfig("o_orderkey", "timestamp", updated_at="o_orderdate"), "2001-09-01 00:00:00")
