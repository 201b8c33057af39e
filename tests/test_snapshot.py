from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright import Storage, TableRef, tables
from tablewright.operators.snapshot import (
    SnapshotColumns, SnapshotConfig, scd_id, snapshot, snapshot_init, snapshot_next,
)

SCHEMA = "id bigint, name string, some_date timestamp_ntz"
TIMES = [f"2024-0{m}-01 00:00:00" for m in range(1, 6)]


def people(spark, count):
    return spark.createDataFrame([(i, f"name{i}", datetime(2020, 1, i)) for i in range(1, count + 1)], SCHEMA)


def states(spark):
    """The source at each of four runs: fewer rows, all rows, later dates, other names."""
    base, added = people(spark, 10), people(spark, 20)
    later = added.withColumn("some_date", F.when(
        (F.col("id") > 10) & (F.col("id") < 21), F.timestamp_add("DAY", F.lit(1), "some_date"))
        .otherwise(F.col("some_date")))
    renamed = later.withColumn("name", F.when(
        F.col("id") < 11, F.concat("name", F.lit("_updated"))).otherwise(F.col("name")))
    return [base, added, later, renamed]


CONFIGS = {
    "timestamp": (SnapshotConfig("id", "timestamp", updated_at="some_date"), [10, 20, 30, 30]),
    "check_all": (SnapshotConfig("id", "check", check_cols="all"), [10, 20, 30, 40]),
    "check_date": (SnapshotConfig("id", "check", check_cols=["some_date"]), [10, 20, 30, 30]),
    "check_name": (SnapshotConfig("id", "check", check_cols=["name"]), [10, 20, 20, 30]),
}


@pytest.mark.parametrize("period", [None, "month"])
@pytest.mark.parametrize("name", CONFIGS)
def test_row_counts_of_four_runs(spark, ns, name, period):
    config, counts = CONFIGS[name]
    ref = TableRef("history", ns)
    got = []
    for source, now in zip(states(spark), TIMES):
        got.append(snapshot(source, ref, config, now, closing_period=period).count())
    assert got == counts
    # The same source again, at the same time or later, adds nothing.
    assert snapshot(states(spark)[-1], ref, config, TIMES[3]).count() == counts[-1]
    assert snapshot(states(spark)[-1], ref, config, TIMES[4]).count() == counts[-1]
    # Every key has one open version and no gap between its versions.
    history = spark.table(ref.sql)
    assert history.filter("scd_valid_to is null").groupBy("id").count().filter("count <> 1").isEmpty()
    ends = history.filter("scd_valid_to is not null").select("id", F.col("scd_valid_to").alias("at"))
    starts = history.select("id", F.col("scd_valid_from").alias("at"))
    assert ends.subtract(starts).isEmpty()


def test_current_rows_equal_the_source(spark):
    config = CONFIGS["check_all"][0]
    history = None
    for source, now in zip(states(spark), TIMES):
        history = snapshot_init(source, config, now) if history is None else snapshot_next(history, source, config, now)
        assert rows(history.filter("scd_valid_to is null"), "id", "name", "some_date") == rows(source)


def test_hard_deletes_and_return(spark):
    for mode, open_rows in (("ignore", 10), ("invalidate", 7)):
        config = SnapshotConfig("id", "check", check_cols="all", hard_deletes=mode)
        source = people(spark, 10)
        history = snapshot_init(source, config, TIMES[0])
        history = snapshot_next(history, source.filter("id > 3"), config, TIMES[1])
        assert history.filter("scd_valid_to is null").count() == open_rows
    gone = history.filter("id <= 3")
    assert {str(r.scd_valid_to) for r in gone.collect()} == {TIMES[1]}
    back = snapshot_next(history, source, config, TIMES[2])
    assert back.count() == 13 and back.filter("scd_valid_to is null").count() == 10


@pytest.mark.parametrize("period", [None, "day"])
def test_everything_deleted(spark, ns, period):
    config = SnapshotConfig("id", "check", check_cols="all", hard_deletes="invalidate")
    ref = TableRef("history", ns)
    snapshot(people(spark, 4), ref, config, TIMES[0], closing_period=period)
    history = snapshot(people(spark, 4).limit(0), ref, config, TIMES[1])
    assert history.count() == 4 and history.filter("scd_valid_to is null").isEmpty()


def test_sentinel_and_names(spark):
    columns = SnapshotColumns.with_prefix("meta_")
    config = SnapshotConfig("id", "check", check_cols="all", columns=columns,
                            valid_to_current="timestamp_ntz '9999-12-31 00:00:00'")
    first, _, later, _ = states(spark)
    history = snapshot_init(first, config, TIMES[0])
    assert [f.name for f in history.schema][3:] == columns.names()
    # An open row that was left NULL counts as open too.
    history = history.withColumn("meta_valid_to", F.when(F.col("id") > 5, F.col("meta_valid_to")))
    after = snapshot_next(history, first.withColumn("name", F.lit("x")), config, TIMES[1])
    assert after.count() == 20
    assert after.filter("meta_valid_to = timestamp_ntz '9999-12-31 00:00:00'").count() == 10


@pytest.mark.parametrize("period", [None, "month"])
def test_columns_come_and_go(spark, ns, period):
    config = SnapshotConfig("id", "check", check_cols="all")
    ref = TableRef("history", ns)
    snapshot(people(spark, 2), ref, config, TIMES[0], closing_period=period)
    wider = people(spark, 3).withColumn("tags", F.create_map(F.lit("k"), F.col("name"))).drop("some_date")
    after = snapshot(wider, ref, config, TIMES[1])
    assert after.count() == 5
    assert after.filter("scd_valid_to is null and some_date is null and tags is not null").count() == 3
    assert snapshot(wider, ref, config, TIMES[2]).count() == 5


def test_closed_months_are_not_rewritten(spark, ns):
    config = SnapshotConfig("id", "check", check_cols="all")
    ref = TableRef("history", ns)
    for i, now in enumerate(TIMES[:4]):
        snapshot(people(spark, 3).withColumn("name", F.lit(f"n{i}")), ref, config, now, closing_period="month")
        if i == 2:
            closed = spark.table(ref.sql).filter("closed_in = date '2024-02-01'").select("_metadata.file_path")
            before = rows(closed.distinct())
    assert len(before) >= 1
    closed = spark.table(ref.sql).filter("closed_in = date '2024-02-01'").select("_metadata.file_path")
    assert rows(closed.distinct()) == before


def test_bad_sources_fail(spark):
    config = CONFIGS["check_all"][0]
    history = snapshot_init(people(spark, 2), config, TIMES[0])
    with pytest.raises(Exception, match="not unique"):
        snapshot_next(history, people(spark, 2).union(people(spark, 1)), config, TIMES[1]).collect()
    missing = people(spark, 1).withColumn("id", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="NULL in unique_key"):
        snapshot_next(history, missing, config, TIMES[1]).collect()


def test_validation(spark, ns):
    for bad in (dict(unique_key=[], strategy="check", check_cols="all"), dict(unique_key="id", strategy="hash"),
                dict(unique_key="id", strategy="timestamp"), dict(unique_key="id", strategy="check"),
                dict(unique_key="id", strategy="check", check_cols="all", hard_deletes="maybe")):
        with pytest.raises(ValueError):
            SnapshotConfig(**bad)
    config = CONFIGS["timestamp"][0]
    ref = TableRef("plain", ns)
    tables.write_table(people(spark, 1), ref)
    with pytest.raises(ValueError, match="not a snapshot table"):
        snapshot(people(spark, 1), ref, config, TIMES[0])
    tables.materialize_view(spark, "SELECT 1 AS id", ref)
    with pytest.raises(ValueError, match="must be a table"):
        snapshot(people(spark, 1), ref, config, TIMES[0])
    with pytest.raises(ValueError, match="csv"):
        snapshot(people(spark, 1), TableRef("h", ns), config, TIMES[0], Storage(fmt="csv"))


def test_scd_id_text(spark):
    row = spark.sql("select 'a' as a, cast(null as string) as b, 3 as c").select(
        scd_id(F.col("a"), F.col("b"), F.col("c")), F.md5(F.lit("a||3"))).first()
    assert row[0] == row[1]


def test_names_that_differ_in_case_are_the_same_column(spark):
    config = SnapshotConfig("ID", "check", check_cols=["Name"])
    first = snapshot_init(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), config, TIMES[0])
    again = snapshot_next(first, spark.createDataFrame([(1, "z"), (3, "c")], "Id int, NAME string"), config, TIMES[1])
    assert again.columns == first.columns
    assert rows(again.filter("scd_valid_to is null"), "id", "name") == [(1, "z"), (2, "b"), (3, "c")]
