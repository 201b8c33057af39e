from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tablewright import TableRef, tables
from tablewright.operators.constraints import Check
from tablewright.operators.views import (
    AggregateView, aggregate_result, aggregate_state, apply_changes, change_feed, create_aggregate,
    materialize_mv, refresh_incremental, require_table_sources,
)
from tablewright.streaming.refresh import applied_batches, stream_refresh
from tablewright.workspace import scratch_path

SCHEMA = "id bigint, name string, amount bigint"
SOURCE = [(1, "alice", 100), (2, "bob", 200), (3, "charlie", 300)]


def made(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_tiers_and_totals(spark, ns):
    source = made(spark, SOURCE)
    tier = F.when(F.col("amount") >= 200, "high").otherwise("low").alias("tier")
    ref = TableRef("tiers", ns)
    for _ in range(2):  # building again changes nothing
        built = materialize_mv(lambda: source.select("id", "name", tier), ref, on_demand=True,
                               partitioned_by="tier", comment="who is big", properties={"owner_team": "sales"})
    assert rows(built, "name", "tier") == [("alice", "low"), ("bob", "high"), ("charlie", "high")]
    assert tables.properties(spark, ref)["owner_team"] == "sales"
    assert tables.partition_columns(spark, ref) == ["tier"]
    totals = materialize_mv(lambda: source.groupBy("name").agg(F.sum("amount").alias("total")),
                            TableRef("totals", ns), scheduled=True)
    assert totals.count() == 3


def test_refresh_must_be_said_and_constraints_guard_the_old_rows(spark, ns):
    ref = TableRef("guarded", ns)
    with pytest.raises(ValueError, match="refreshed"):
        materialize_mv(lambda: made(spark, SOURCE), ref)
    materialize_mv(lambda: made(spark, SOURCE), ref, on_demand=True)
    with pytest.raises(Exception, match="constraint big violated"):
        materialize_mv(lambda: made(spark, [(9, "x", 1)]), ref, on_demand=True, checks=[Check("amount > 50", "big")])
    assert rows(spark.table(ref.sql)) == SOURCE
    kept = materialize_mv(lambda: made(spark, SOURCE), ref, on_demand=True,
                          checks=[Check("amount > 150", "big", "DROP")])
    assert kept.count() == 2


def test_a_view_of_that_name_is_replaced(spark, ns):
    ref = TableRef("model", ns)
    tables.materialize_view(spark, "SELECT 1 AS id", ref)
    materialize_mv(lambda: made(spark, SOURCE), ref, on_demand=True)
    assert tables.table_kind(spark, ref) == "table"


def test_sources_must_be_tables(spark, ns):
    tables.write_table(made(spark, SOURCE), TableRef("t", ns))
    tables.materialize_view(spark, "SELECT 1 AS id", TableRef("v", ns))
    assert require_table_sources(spark, [f"{ns}.t", f"{ns}.missing"]) == [TableRef("missing", ns).sql]
    with pytest.raises(ValueError, match="is a view"):
        require_table_sources(spark, [f"{ns}.v"])


def test_change_feed(spark):
    new = made(spark, [(1, "alice", 100), (2, "bob", None), (4, "dora", 5)])
    assert rows(change_feed(made(spark, SOURCE), new, "id")) == sorted([
        (2, "bob", 200, "update_preimage"), (2, "bob", None, "update_postimage"),
        (3, "charlie", 300, "delete"), (4, "dora", 5, "insert")], key=repr)
    with pytest.raises(Exception, match="not unique or NULL"):
        change_feed(made(spark, SOURCE + SOURCE[:1]), new, "id").collect()
    with pytest.raises(Exception, match="not unique or NULL"):
        change_feed(made(spark, [(None, "n", 1)]), new, "id").collect()


VIEW = AggregateView("name", sums={"total": "amount"}, extremes={"least": ("min", "amount"), "most": ("max", "amount")})
ROWS = st.dictionaries(
    st.integers(0, 6), st.tuples(st.sampled_from(["a", "b", None]), st.integers(-5, 5) | st.none()), max_size=7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_incremental_refresh_equals_recomputing(spark, old, new):
    before, after = (made(spark, [(k, *v) for k, v in d.items()]) for d in (old, new))
    feed = change_feed(before, after, "id")
    state = apply_changes(aggregate_state(before, VIEW), feed, VIEW, after)
    assert rows(aggregate_result(state, VIEW)) == rows(aggregate_result(aggregate_state(after, VIEW), VIEW))


@pytest.mark.parametrize("gone", [1e17, float("nan"), float("inf")])
def test_floating_sums_are_recomputed(spark, ns, gone):
    schema = "id int, name string, amount double"
    old = spark.createDataFrame([(1, "a", 0.1), (2, "a", gone), (3, "b", 0.5), (4, "c", None)], schema)
    new = spark.createDataFrame([(1, "a", 0.1), (3, "b", 0.5), (4, "c", None), (5, "b", 0.25)], schema)
    view, ref = AggregateView("name", sums={"total": "amount"}), TableRef("floating", ns)
    create_aggregate(old, ref, view)
    feed = change_feed(old, new, "id")
    with pytest.raises(ValueError, match="base rows"):
        refresh_incremental(ref, feed, view)
    with pytest.raises(ValueError, match="floating sums"):
        stream_refresh(spark, scratch_path(spark, "feed"), feed.schema, ref, view, scratch_path(spark, "checkpoint"))
    got = aggregate_result(refresh_incremental(ref, feed, view, base=new), view)
    assert rows(got) == [("a", 1, 0.1), ("b", 2, 0.75), ("c", 1, None)]


def test_refresh_of_a_hot_group(spark, ns, shuffled):
    """A third of the rows are in one group; half of them go."""
    base = spark.range(3000).select(
        "id", F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") / 10)).alias("name"),
        F.col("id").alias("amount"))
    after = base.filter("id >= 500")
    ref = TableRef("state", ns)
    create_aggregate(base, ref, VIEW)
    got = aggregate_result(refresh_incremental(ref, change_feed(base, after, "id"), VIEW, base=after), VIEW)
    hot = got.filter("name = 'hot'").first()
    assert (hot.n_rows, hot.total, hot.least, hot.most) == (500, sum(range(500, 1000)), 500, 999)
    with pytest.raises(ValueError, match="base rows"):
        refresh_incremental(ref, change_feed(base, after, "id"), VIEW)
    with pytest.raises(ValueError, match="must be a table"):
        refresh_incremental(TableRef("nothing", ns), change_feed(base, after, "id"), VIEW)


def test_stream_counts_every_change_once(spark, ns):
    sums = AggregateView("name", sums={"total": "amount"})
    ref = TableRef("streamed", ns)
    states = [made(spark, SOURCE), made(spark, SOURCE[:2] + [(3, "charlie", 1)]), made(spark, SOURCE[1:])]
    create_aggregate(states[0], ref, sums)
    path, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "checkpoint")
    for old, new in zip(states, states[1:]):
        feed = change_feed(old, new, "id")
        feed.coalesce(1).write.mode("append").parquet(path)
        for _ in range(2):
            state = stream_refresh(spark, path, feed.schema, ref, sums, checkpoint, files_per_batch=1)
        assert rows(aggregate_result(state, sums)) == rows(aggregate_result(aggregate_state(new, sums), sums))
    assert list(applied_batches(spark, ref).values()) == [1]
    # Another checkpoint would deliver the batches again: it is refused, also after a rewrite of the table.
    tables.rewrite(tables.fresh(spark, ref), ref)
    with pytest.raises(ValueError, match="does not know the stream"):
        stream_refresh(spark, path, feed.schema, ref, sums, scratch_path(spark, "checkpoint"), files_per_batch=1)
    # A further feed starts at its own batch 0, and nothing of either is skipped or counted twice.
    further, its_checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "checkpoint")
    last = states[-1].union(spark.createDataFrame([states[-1].first()], states[-1].schema).withColumn("id", F.lit(999).cast("bigint")))
    change_feed(states[-1], last, "id").coalesce(1).write.parquet(further)
    for fresh_stream in (True, False):
        state = stream_refresh(spark, further, feed.schema, ref, sums, its_checkpoint, new_stream=fresh_stream)
        state = stream_refresh(spark, path, feed.schema, ref, sums, checkpoint, files_per_batch=1)
        assert rows(aggregate_result(state, sums)) == rows(aggregate_result(aggregate_state(last, sums), sums))
    assert sorted(applied_batches(spark, ref).values()) == [0, 1]
    with pytest.raises(ValueError, match="min and max"):
        stream_refresh(spark, path, feed.schema, ref, VIEW, checkpoint)


def test_timestamps_as_extremes(spark):
    view = AggregateView("name", extremes={"last": ("max", "at")})
    schema = "id int, name string, at timestamp_ntz"
    old = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (2, "a", datetime(2024, 1, 3))], schema)
    new = old.filter("id = 1")
    state = apply_changes(aggregate_state(old, view), change_feed(old, new, "id"), view, new)
    assert rows(aggregate_result(state, view)) == [("a", 1, datetime(2024, 1, 1))]
    with pytest.raises(ValueError):
        AggregateView("name", extremes={"x": ("median", "at")})
    with pytest.raises(ValueError):
        AggregateView([])
