"""Incremental models on the orders table.

The first run has the orders placed before 2000.  The second batch brings every order from 1999
on: the year 1999 again with a corrected price, and the orders placed since.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.naming import TableRef
from tablewright.operators import incremental as inc
from tablewright.operators.buckets import BUCKET, create_bucketed, merge_bucketed
from tablewright.operators.merge import merge_into
from tablewright.operators.schema_change import apply_schema_change, widen_column
from tablewright.plans.registry import query, table
from tablewright.tables import Storage
from tablewright.workspace import scratch_namespace


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.col("o_orderdate") < at("2000-01-01"))


def second_batch(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.col("o_orderdate") >= at("1999-01-01")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)


FIRST = "select * from orders where o_orderdate < timestamp '2000-01-01'"
KEPT = "select * from orders where o_orderdate < timestamp '1999-01-01'"
SECOND = ("select * replace (o_totalprice + 1 as o_totalprice) from orders "
          "where o_orderdate >= timestamp '1999-01-01'")
BY_YEAR = ", cast(year(o_orderdate) as integer) as o_year"


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("o_year", F.year("o_orderdate"))


def started(spark: SparkSession, sf: str, label: str, **storage: object) -> TableRef:
    """The table after the first run."""
    ref = TableRef("orders", scratch_namespace(spark, label))
    rows = first_rows(spark, sf)
    tables.write_table(with_year(rows) if storage.get("partition_by") == "o_year" else rows, ref, Storage(**storage))
    return ref


@query("incremental_append", f"{FIRST} union all {SECOND}")
def append(spark: SparkSession, sf: str) -> DataFrame:
    return inc.append(started(spark, sf, "append"), second_batch(spark, sf))


@query("incremental_overwrite_all", SECOND)
def overwrite_all(spark: SparkSession, sf: str) -> DataFrame:
    return inc.insert_overwrite(started(spark, sf, "overwrite"), second_batch(spark, sf))


@query("incremental_overwrite_partitions", f"select *{BY_YEAR} from ({KEPT} union all {SECOND})")
def overwrite_partitions(spark: SparkSession, sf: str) -> DataFrame:
    ref = started(spark, sf, "dynamic", partition_by="o_year")
    return inc.insert_overwrite(ref, with_year(second_batch(spark, sf)))


@query("microbatch_replace", f"select *{BY_YEAR} from ({KEPT} union all {SECOND})")
def microbatch_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The table is not partitioned by the column that says what to replace."""
    ref = TableRef("orders", scratch_namespace(spark, "replace"))
    tables.write_table(with_year(first_rows(spark, sf)), ref)
    return inc.replace_partitions(ref, with_year(second_batch(spark, sf)), "o_year")


@query("microbatch_event_time", "select *, cast(ts as date) as event_day from events")
def microbatch_event_time(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping runs of daily slices; every event ends up in the table once."""
    ref = TableRef("events_by_day", scratch_namespace(spark, "slices"))
    events = table(spark, sf, "events")
    for begin, end in ((datetime(2024, 1, 1), datetime(2024, 1, 15, 13, 57)),
                       (datetime(2024, 1, 10), datetime(2024, 1, 31))):
        inc.microbatch(
            ref, events, lambda df: df.withColumn("event_day", F.to_date("ts")), event_time="ts", batch_size="day",
            begin=begin, end=end, partition_by="event_day", rowwise=True)
    return spark.table(ref.sql)


@query("merge_unique_key", f"{KEPT} union all {SECOND}")
def unique_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge_into(started(spark, sf, "merge"), second_batch(spark, sf), "o_orderkey")


@query("merge_bucketed", f"{KEPT} union all {SECOND}")
def bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Only the buckets of the batch's keys are rewritten."""
    ref = TableRef("orders", scratch_namespace(spark, "merge"))
    create_bucketed(first_rows(spark, sf), ref, "o_orderkey", 8)
    return merge_bucketed(ref, second_batch(spark, sf)).drop(BUCKET)


@query("merge_composite_key", f"{KEPT} union all {SECOND}")
def composite_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge_into(started(spark, sf, "merge"), second_batch(spark, sf), ["o_custkey", "o_orderkey", "o_custkey"])


@query("merge_no_key", f"{FIRST} union all {SECOND}")
def no_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge_into(started(spark, sf, "merge"), second_batch(spark, sf), [])


def revised(spark: SparkSession, sf: str) -> DataFrame:
    return second_batch(spark, sf).withColumn("o_orderpriority", F.lit("REVISED"))


_NEW = ("select * replace (o_totalprice + 1 as o_totalprice, 'REVISED' as o_orderpriority) from orders "
        "where o_orderdate >= timestamp '2000-01-01'")
_AGAIN = "from orders where o_orderdate >= timestamp '1999-01-01' and o_orderdate < timestamp '2000-01-01'"


@query("merge_update_columns",
       f"{KEPT} union all select * replace (o_totalprice + 1 as o_totalprice) {_AGAIN} union all {_NEW}")
def update_columns(spark: SparkSession, sf: str) -> DataFrame:
    return merge_into(started(spark, sf, "merge"), revised(spark, sf), "o_orderkey", update_columns="o_totalprice")


@query("merge_exclude_columns",
       f"{KEPT} union all select * replace ('REVISED' as o_orderpriority) {_AGAIN} union all {_NEW}")
def exclude_columns(spark: SparkSession, sf: str) -> DataFrame:
    return merge_into(started(spark, sf, "merge"), revised(spark, sf), "o_orderkey", exclude_columns=["O_TOTALPRICE"])


@query("merge_predicates", f"""
select * from orders where o_orderdate < timestamp '1999-01-01'
    or (o_orderdate < timestamp '2000-01-01' and o_orderstatus = 'P')
union all {SECOND}
""")
def predicates(spark: SparkSession, sf: str) -> DataFrame:
    return merge_into(started(spark, sf, "merge"), second_batch(spark, sf), "o_orderkey",
                      predicates=["target.o_orderstatus <> 'P'"])


@query("merge_predicates_both_sides", """
with batch as (
    select * replace (case when o_orderstatus = 'F' then o_totalprice - 1 else o_totalprice + 1 end as o_totalprice)
    from orders where o_orderdate >= timestamp '1999-01-01')
select * from orders where o_orderdate < timestamp '1999-01-01'
    or (o_orderdate < timestamp '2000-01-01' and o_orderstatus = 'F')
union all select * from batch
""")
def predicates_both_sides(spark: SparkSession, sf: str) -> DataFrame:
    """Only a higher price updates; a lower one is added beside the old row."""
    batch = table(spark, sf, "orders").filter(F.col("o_orderdate") >= at("1999-01-01")).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") - 1)
        .otherwise(F.col("o_totalprice") + 1))
    return merge_into(started(spark, sf, "merge"), batch, "o_orderkey",
                      predicates=["source.o_totalprice > target.o_totalprice"])


@query("merge_partitioned", f"select *{BY_YEAR} from ({KEPT} union all {SECOND})")
def partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Only the partitions of the batch and of the rows it matches are rewritten."""
    ref = started(spark, sf, "merge", partition_by="o_year")
    return merge_into(ref, with_year(second_batch(spark, sf)), "o_orderkey")


@query("merge_partition_move", """
select * replace (case when o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus) from orders
""")
def partition_move(spark: SparkSession, sf: str) -> DataFrame:
    """Every pending order is finished: its rows move to another partition and their old one is cleared."""
    ref = TableRef("orders", scratch_namespace(spark, "move"))
    orders = table(spark, sf, "orders")
    tables.write_table(orders, ref, Storage(partition_by="o_orderstatus"))
    finished = orders.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F"))
    return merge_into(ref, finished, "o_orderkey")


@query("incremental_watermark", "select * from orders")
def watermark(spark: SparkSession, sf: str) -> DataFrame:
    ref = started(spark, sf, "watermark")
    return inc.append(ref, inc.high_watermark(spark, table(spark, sf, "orders"), ref, "o_orderdate"))


@query("incremental_full_refresh", "select * from orders")
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    ref = started(spark, sf, "refresh")

    def model(is_incremental: bool) -> DataFrame:
        return second_batch(spark, sf) if is_incremental else table(spark, sf, "orders")

    return inc.build_incremental(spark, ref, model, strategy="merge", unique_key="o_orderkey", full_refresh=True)


def _changed_schema(spark: SparkSession, sf: str, policy: str, drop: str | None = None, **options: object) -> DataFrame:
    ref = started(spark, sf, "schema")

    def model(is_incremental: bool) -> DataFrame:
        batch = second_batch(spark, sf).withColumn("channel", F.concat(F.lit("web-"), F.col("o_orderstatus")))
        return batch.drop(drop) if drop else batch

    return inc.build_incremental(spark, ref, model, on_schema_change=policy, **options)


@query("schema_change_ignore", f"{FIRST} union all {SECOND}")
def schema_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return _changed_schema(spark, sf, "ignore")


@query("schema_change_append", f"""
select *, cast(null as varchar) as channel from ({FIRST})
union all select *, 'web-' || o_orderstatus as channel from ({SECOND})
""")
def schema_append(spark: SparkSession, sf: str) -> DataFrame:
    return _changed_schema(spark, sf, "append_new_columns")


@query("schema_change_sync", f"""
select * exclude (o_orderpriority), cast(null as varchar) as channel from ({KEPT})
union all select * exclude (o_orderpriority), 'web-' || o_orderstatus as channel from ({SECOND})
""")
def schema_sync(spark: SparkSession, sf: str) -> DataFrame:
    return _changed_schema(spark, sf, "sync_all_columns", drop="o_orderpriority", allow_drop=True,
                           strategy="merge", unique_key="o_orderkey")


@query("widen_column", "select * replace (cast(l_linenumber as bigint) as l_linenumber) from lineitem")
def widen(spark: SparkSession, sf: str) -> DataFrame:
    ref = TableRef("lineitem", scratch_namespace(spark, "widen"))
    tables.write_table(table(spark, sf, "lineitem"), ref)
    return widen_column(spark, ref, "l_linenumber", "bigint")


@query("columns_by_catalog", """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_shipdate, cast(null as varchar) as note,
       cast(null as double) as l_quantity from lineitem
union all select l_orderkey, l_linenumber + 5000000000, l_shipdate, 'late', l_quantity from lineitem where l_linenumber = 7
""")
def columns_by_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A column gets wider, one goes and one comes without a file touched; the dropped one's name comes back empty."""
    ref = TableRef("lineitem", scratch_namespace(spark, "columns"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    tables.write_table(lines, ref)
    late = lines.filter("l_linenumber = 7").select(
        "l_orderkey", (F.col("l_linenumber") + F.lit(5_000_000_000)).alias("l_linenumber"), "l_shipdate",
        F.lit("late").alias("note"), "l_quantity")
    apply_schema_change(ref, late.drop("l_quantity"), "sync_all_columns", allow_drop=True)
    return tables.append_rows(apply_schema_change(ref, late, "append_new_columns"), ref)
