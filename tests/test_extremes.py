"""Extremes that are taken back from bounded lists."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tablewright import TableRef
from tablewright.operators.views import (
    AggregateView, aggregate_result, aggregate_state, apply_changes, change_feed, create_aggregate, refresh_incremental,
)
from tablewright.streaming.refresh import stream_refresh
from tablewright.workspace import scratch_path

SCHEMA = "id bigint, name string, amount bigint"
VIEW = AggregateView("name", sums={"total": "amount"}, extremes={"least": ("min", "amount"), "most": ("max", "amount")}, kept=3)
ROWS = st.dictionaries(st.integers(0, 9), st.tuples(st.sampled_from(["a", "b", None]), st.integers(-3, 3) | st.none()), max_size=10)


def made(spark, data):
    return spark.createDataFrame([(k, *v) for k, v in data.items()] if isinstance(data, dict) else data, SCHEMA)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_lists_give_what_recomputing_gives(spark, ns, old, new):
    before, after = made(spark, old), made(spark, new)
    ref = TableRef("kept", ns)
    create_aggregate(before, ref, VIEW)
    got = refresh_incremental(ref, change_feed(before, after, "id"), VIEW, base=after)
    assert rows(aggregate_result(got, VIEW)) == rows(aggregate_result(aggregate_state(after, VIEW), VIEW))


def test_deletions_take_the_next_value_without_the_base(spark, ns):
    """Of ten values three are listed; two feeds delete one after the other, the third empties the list."""
    data = {i: ("a", i) for i in range(10)}
    states = [made(spark, {i: v for i, v in data.items() if i >= least}) for least in (0, 1, 2)]
    ref, view = TableRef("kept", ns), AggregateView("name", extremes={"least": ("min", "amount")}, kept=3)
    create_aggregate(states[0], ref, view)
    for number, (old, new) in enumerate(zip(states, states[1:]), 1):
        feed = change_feed(old, new, "id")
        got = refresh_incremental(ref, feed, view)  # there is no base to read
        assert got.first()["least"] == number
        assert [e["value"] for e in got.first()["least__kept"]] == list(range(number, 3)) and got.first()["least__more"] == 7
    last = made(spark, {i: v for i, v in data.items() if i >= 5})
    feed = change_feed(states[-1], last, "id")
    with pytest.raises(ValueError, match="run empty"):
        refresh_incremental(ref, feed, view)
    assert spark.table(ref.sql).first()["least"] == 2  # nothing was touched
    got = refresh_incremental(ref, feed, view, base=last)
    assert got.first()["least"] == 5 and [e["value"] for e in got.first()["least__kept"]] == [5, 6, 7]


def test_the_plan_of_a_refresh_does_not_scan_the_base(spark, ns, tmp_path):
    made(spark, {i: ("a", i) for i in range(10)}).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    state = aggregate_state(base, VIEW)
    state.write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    feed = spark.createDataFrame([(0, "a", 0, "delete")], SCHEMA + ", _change_type string")
    plan = apply_changes(state, feed, VIEW, base)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [name#" in plan and "Relation [id#" not in plan


def test_a_hot_group_and_ties(spark, ns):
    base = spark.range(4000).select("id", F.when(F.col("id") < 2000, "hot").otherwise((F.col("id") % 50).cast("string")).alias("name"),
                                    (F.col("id") % 7).alias("amount"))
    after = base.filter("amount > 1 or name <> 'hot'")
    ref = TableRef("hot", ns)
    create_aggregate(base, ref, VIEW)
    got = aggregate_result(refresh_incremental(ref, change_feed(base, after, "id"), VIEW), VIEW)
    assert rows(got) == rows(aggregate_result(aggregate_state(after, VIEW), VIEW))


def test_streams_take_extremes_back(spark, ns):
    view = AggregateView("name", extremes={"most": ("max", "amount")}, kept=2)
    states = [made(spark, {i: ("a", i) for i in range(n)}) for n in (6, 5, 4)]
    ref, path, checkpoint = TableRef("streamed", ns), scratch_path(spark, "feed"), scratch_path(spark, "checkpoint")
    create_aggregate(states[0], ref, view)
    for old, new in zip(states, states[1:]):
        feed = change_feed(old, new, "id")
        feed.coalesce(1).write.mode("append").parquet(path)
        state = stream_refresh(spark, path, feed.schema, ref, view, checkpoint, base=lambda: new)
        assert rows(aggregate_result(state, view)) == rows(aggregate_result(aggregate_state(new, view), view))
    with pytest.raises(ValueError, match="negative"):
        AggregateView("name", kept=-1)
