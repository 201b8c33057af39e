"""Floating sums that are taken back exactly."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tablewright import TableRef
from tablewright.operators.exact import summed, together, total
from tablewright.operators.views import (
    AggregateView, aggregate_result, aggregate_state, change_feed, create_aggregate, refresh_incremental,
)
from tablewright.streaming.refresh import stream_refresh
from tablewright.workspace import scratch_path

SCHEMA = "id int, name string, amount double"
VIEW = AggregateView("name", sums={"total": "amount"}, exact=True)


def test_sums_are_rounded_once(spark):
    """Against the exact sum of the standard library."""
    cases = [
        [0.1] * 10, [1e17, 0.1, -1e17], [1e308, 1e-308, -1e308], [5e-324, 5e-324], [1.0, 2.0 ** -53], [1.0, 2.0 ** -53, 5e-324],
        [-1.0, -(2.0 ** -53), -(2.0 ** -80)], [0.0, -0.0], [1e16, 1.0, 1.0], [2.0 ** 1023, -(2.0 ** 970)], [3.0, -3.0],
        [2.0 ** 24, -(2.0 ** -24), 2.0 ** 48], [-7.25, 1e-200, 1e200, -1e200], [2.2250738585072014e-308, -5e-324],
        [1.7976931348623157e308], [float(2 ** 53 + 2), 1.0, 2.0 ** -30],
    ]
    data = [(i, x) for i, case in enumerate(cases) for x in case]
    sums = summed(spark.createDataFrame(data, "i int, x double"), ["i"], "x", F.lit(1))
    got = {r.i: r.t for r in sums.select("i", total(F.col("parts")).alias("t")).collect()}
    assert [got.get(i, 0.0) for i in range(len(cases))] == [math.fsum(case) for case in cases]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=30))
def test_any_doubles(spark, values):
    rows_ = spark.createDataFrame([(1, x) for x in values], "i int, x double")
    plus = summed(rows_, ["i"], "x", F.lit(1))
    found = plus.select(total(F.col("parts"))).first()
    assert (found[0] if found else 0.0) == math.fsum(values)
    minus = summed(rows_, ["i"], "x", F.lit(-1)).withColumnRenamed("parts", "less")
    left = plus.join(minus, "i").select(F.size(together(F.col("parts"), F.col("less")))).collect()
    assert all(r[0] == 0 for r in left)


def test_deletions_leave_nothing_behind(spark, ns):
    """Neither the base nor a stream without it is needed; NaN and infinities go with their rows."""
    inf, nan = float("inf"), float("nan")
    old = [(1, "a", 0.1), (2, "a", 1e17), (3, "b", nan), (4, "b", 0.5), (5, "c", inf), (6, "c", -inf), (7, None, 2.5),
           (8, "d", None), (9, "e", 1.0)]
    states = [old, [r for r in old if r[0] not in (2, 3, 6)], [r for r in old if r[0] not in (2, 3, 5, 6, 9)] + [(10, "f", -0.25), (11, "f", None)]]
    states = [spark.createDataFrame(s, SCHEMA) for s in states]
    batch, streamed = TableRef("batch", ns), TableRef("streamed", ns)
    create_aggregate(states[0], batch, VIEW)
    create_aggregate(states[0], streamed, VIEW)
    shown = {r["name"]: r["total"] for r in aggregate_result(spark.table(batch.sql), VIEW).collect()}
    assert math.isnan(shown["b"]) and math.isnan(shown["c"]) and shown["a"] == 1e17
    path, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "checkpoint")
    wanted = [[("a", 1, 0.1), ("b", 1, 0.5), ("c", 1, inf), ("d", 1, None), ("e", 1, 1.0), (None, 1, 2.5)],
              [("a", 1, 0.1), ("b", 1, 0.5), ("d", 1, None), ("f", 2, -0.25), (None, 1, 2.5)]]
    for before, after, want in zip(states, states[1:], wanted):
        feed = change_feed(before, after, "id")
        feed.coalesce(1).write.mode("append").parquet(path)
        got = refresh_incremental(batch, feed, VIEW)
        assert rows(aggregate_result(got, VIEW)) == sorted(want, key=repr)
        assert rows(got) == rows(aggregate_state(after, VIEW).select(*got.columns))  # the state, too
        got = stream_refresh(spark, path, feed.schema, streamed, VIEW, checkpoint)
        assert rows(aggregate_result(got, VIEW)) == sorted(want, key=repr)


def test_empty_and_float_columns(spark, ns):
    nothing = spark.createDataFrame([], "id int, name string, amount float")
    ref = TableRef("floats", ns)
    create_aggregate(nothing, ref, VIEW)
    after = spark.createDataFrame([(1, "a", 0.1), (2, "a", 0.2)], nothing.schema)
    got = refresh_incremental(ref, change_feed(nothing, after, "id"), VIEW)
    kept = after.select(F.col("amount").cast("double")).collect()
    assert rows(aggregate_result(got, VIEW)) == [("a", 2, math.fsum(r[0] for r in kept))]


def test_exact_sums_beside_lists_of_extremes(spark, ns):
    view = AggregateView("name", sums={"total": "amount"}, extremes={"most": ("max", "amount")}, kept=3, exact=True)
    old = spark.createDataFrame([(1, "a", 0.1), (2, "a", 1e17), (3, "a", 0.25)], SCHEMA)
    ref = TableRef("both", ns)
    create_aggregate(old, ref, view)
    got = refresh_incremental(ref, change_feed(old, old.filter("id <> 2"), "id"), view)
    assert rows(aggregate_result(got, view)) == [("a", 2, math.fsum([0.1, 0.25]), 0.25)]
