"""Type-2 history of the orders table.

The source is first seen with the orders placed before 2000, then whole: open orders of 1999 have
been finished (90 days after they were placed), and orders placed since are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.naming import TableRef
from tablewright.operators.snapshot import SnapshotConfig, scd_id, snapshot
from tablewright.plans.incremental import at
from tablewright.plans.registry import query, table
from tablewright.workspace import scratch_namespace

T0, T1 = "2000-01-01 00:00:00", "2001-09-01 00:00:00"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _finished_late():
    return ((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= at("1999-01-01"))
            & (F.col("o_orderdate") < at("2000-01-01")))


def source_before(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*COLUMNS, F.col("o_orderdate").alias("changed_at")).filter(
        F.col("o_orderdate") < at("2000-01-01"))


def source_after(spark: SparkSession, sf: str) -> DataFrame:
    late = _finished_late()
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.when(late, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderdate", "o_orderpriority",
        F.when(late, F.timestamp_add("DAY", F.lit(90), "o_orderdate")).otherwise(F.col("o_orderdate"))
        .alias("changed_at"))


_COLS = ", ".join(COLUMNS)
BEFORE = f"select {_COLS}, o_orderdate as changed_at from orders where o_orderdate < timestamp '2000-01-01'"
_LATE = "o_orderstatus = 'O' and o_orderdate >= timestamp '1999-01-01' and o_orderdate < timestamp '2000-01-01'"
AFTER = f"""select o_orderkey, o_custkey, case when {_LATE} then 'F' else o_orderstatus end as o_orderstatus,
    o_orderdate, o_orderpriority,
    case when {_LATE} then o_orderdate + interval 90 day else o_orderdate end as changed_at from orders"""


def history(
    differs: str, was: str = "a.changed_at", now: str = "b.changed_at",
    before: str = BEFORE, after: str = AFTER, current: str = "null", gone: str | None = None,
) -> str:
    """SQL for the history after both runs.

    ``differs`` tells an old row ``a`` from a new row ``b``; ``was`` and ``now`` are the times their
    versions begin; ``gone`` closes rows that left the source.
    """
    left = f"when b.o_orderkey is null then {gone}" if gone else ""
    return f"""
with before as ({before}), after as ({after}),
old_versions as (
    select a.*, md5(cast(a.o_orderkey as varchar) || '|' || cast({was} as varchar)) as scd_id,
           {was} as scd_updated_at, {was} as scd_valid_from,
           cast(case when {differs} then {now} {left} else {current} end as timestamp) as scd_valid_to
    from before a left join after b on a.o_orderkey = b.o_orderkey),
new_versions as (
    select b.*, md5(cast(b.o_orderkey as varchar) || '|' || cast({now} as varchar)) as scd_id,
           {now} as scd_updated_at, {now} as scd_valid_from, cast({current} as timestamp) as scd_valid_to
    from after b left join before a on a.o_orderkey = b.o_orderkey
    where a.o_orderkey is null or {differs})
select * from old_versions union all by name select * from new_versions
"""


TIMESTAMP = SnapshotConfig("o_orderkey", "timestamp", updated_at="changed_at")
NEWER = "b.changed_at > a.changed_at"
FIRST_RUN, SECOND_RUN = f"timestamp '{T0}'", f"timestamp '{T1}'"


def run_twice(spark: SparkSession, before: DataFrame, after: DataFrame, config: SnapshotConfig,
              **options: object) -> DataFrame:
    ref = TableRef("orders_history", scratch_namespace(spark, "history"))
    snapshot(before, ref, config, T0, **options)
    return snapshot(after, ref, config, T1, stage=False, **options)  # both sources are plain scans


@query("snapshot_initial", f"""
select *, md5(cast(o_orderkey as varchar) || '|' || cast(changed_at as varchar)) as scd_id,
       changed_at as scd_updated_at, changed_at as scd_valid_from, cast(null as timestamp) as scd_valid_to
from ({AFTER})
""")
def initial(spark: SparkSession, sf: str) -> DataFrame:
    ref = TableRef("orders_history", scratch_namespace(spark, "history"))
    return snapshot(source_after(spark, sf), ref, TIMESTAMP, T0)


@query("snapshot_timestamp", history(NEWER))
def by_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return run_twice(spark, source_before(spark, sf), source_after(spark, sf), TIMESTAMP)


@query("snapshot_by_period",
       f"select *, cast(date_trunc('month', scd_valid_to) as date) as closed_in from ({history(NEWER)})")
def by_period(spark: SparkSession, sf: str) -> DataFrame:
    """The same history, stored so that a run leaves old months alone."""
    return run_twice(spark, source_before(spark, sf), source_after(spark, sf), TIMESTAMP, closing_period="month")


@query("snapshot_check_all", history(
    "(b.o_orderstatus is distinct from a.o_orderstatus or b.changed_at is distinct from a.changed_at) "
    "and b.o_orderkey is not null", FIRST_RUN, SECOND_RUN))
def check_all(spark: SparkSession, sf: str) -> DataFrame:
    config = SnapshotConfig("o_orderkey", "check", check_cols="all")
    return run_twice(spark, source_before(spark, sf), source_after(spark, sf), config)


_REPRIORITISED = "select * replace (case when o_orderpriority = '1-URGENT' then '2-HIGH' else o_orderpriority end " \
                 f"as o_orderpriority) from ({AFTER})"


@query("snapshot_check_list", history(
    "b.o_orderpriority <> a.o_orderpriority", FIRST_RUN, SECOND_RUN, after=_REPRIORITISED))
def check_list(spark: SparkSession, sf: str) -> DataFrame:
    """Only the priority is watched; a new status alone is not seen."""
    config = SnapshotConfig("o_orderkey", "check", check_cols=["o_orderpriority"])
    after = source_after(spark, sf).withColumn("o_orderpriority", F.when(
        F.col("o_orderpriority") == "1-URGENT", "2-HIGH").otherwise(F.col("o_orderpriority")))
    return run_twice(spark, source_before(spark, sf), after, config)


_PURGED = f"select * from ({AFTER}) where not (o_orderstatus = 'P' and o_orderdate < timestamp '1996-01-01')"


@query("snapshot_hard_delete", history(NEWER, after=_PURGED, gone=SECOND_RUN))
def hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Pending orders from before 1996 are gone from the source, and their versions are closed."""
    config = SnapshotConfig("o_orderkey", "timestamp", updated_at="changed_at", hard_deletes="invalidate")
    after = source_after(spark, sf).filter(
        ~((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < at("1996-01-01"))))
    return run_twice(spark, source_before(spark, sf), after, config)


@query("snapshot_sentinel", history(NEWER, current="timestamp '9999-12-31 00:00:00'"))
def sentinel(spark: SparkSession, sf: str) -> DataFrame:
    config = SnapshotConfig("o_orderkey", "timestamp", updated_at="changed_at",
                            valid_to_current="timestamp_ntz '9999-12-31 00:00:00'")
    return run_twice(spark, source_before(spark, sf), source_after(spark, sf), config)


@query("snapshot_new_column", history(
    NEWER, before=BEFORE.replace(" from orders", ", cast(null as varchar) as channel from orders"),
    after=f"select *, 'web-' || o_orderstatus as channel from ({AFTER})"))
def new_column(spark: SparkSession, sf: str) -> DataFrame:
    after = source_after(spark, sf).withColumn("channel", F.concat(F.lit("web-"), F.col("o_orderstatus")))
    return run_twice(spark, source_before(spark, sf), after, TIMESTAMP)


@query("scd_hash", """
select o_orderkey, md5(cast(o_orderkey as varchar) || '|' || o_orderstatus || '|' ||
                       coalesce(nullif(o_orderpriority, '5-LOW'), '')) as row_hash
from orders
""")
def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    """A NULL counts as empty text."""
    return table(spark, sf, "orders").select("o_orderkey", scd_id(
        F.col("o_orderkey"), F.col("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
    ).alias("row_hash"))
