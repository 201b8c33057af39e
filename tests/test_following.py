"""Maintained joins, change logs and the choice of refresh."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tablewright import TableRef, tables
from tablewright.operators import changelog as log
from tablewright.operators.choice import held_versions, refresh
from tablewright.operators.joins import JoinView, create_join, join_changes, joined, refresh_join
from tablewright.operators.views import AggregateView, aggregate_result, aggregate_state, apply_changes, change_feed

LEFT, RIGHT = "id bigint, ref bigint, a string", "rid bigint, ref bigint, b string"
VIEW = JoinView(on={"ref": "ref"}, key=["id", "rid"], columns={
    "id": ("left", "id"), "rid": ("right", "rid"), "a": ("left", "a"), "b": ("right", "b")})
SIDE = st.dictionaries(st.integers(0, 5), st.tuples(st.integers(0, 2) | st.none(), st.sampled_from(["x", "y", None])), max_size=6)


def side(spark, data, schema):
    return spark.createDataFrame([(k, *v) for k, v in data.items()], schema)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SIDE, SIDE, SIDE, SIDE)
def test_a_refreshed_join_equals_a_rebuilt_one(spark, ns, left, left_after, right, right_after):
    a, b = (side(spark, d, LEFT) for d in (left, left_after))
    c, d = (side(spark, x, RIGHT) for x in (right, right_after))
    ref = TableRef("kept", ns)
    create_join(a, c, ref, VIEW)
    got = refresh_join(ref, b, change_feed(a, b, "id"), d, change_feed(c, d, "rid"), VIEW)
    assert rows(got) == rows(joined(b, d, VIEW))


def test_a_hot_key_that_changes_on_both_sides(spark, ns):
    """Every left row meets the same right rows; both sides gain and lose some in the same step."""
    a = spark.range(400).select("id", F.lit(7).cast("bigint").alias("ref"), F.lit("x").alias("a"))
    b = a.filter("id >= 50").unionByName(spark.range(1000, 1040).select("id", F.lit(7).cast("bigint").alias("ref"), F.lit("x").alias("a")))
    c = side(spark, {1: (7, "p"), 2: (7, "q"), 3: (None, "r")}, RIGHT)
    d = side(spark, {2: (7, "changed"), 3: (7, "r")}, RIGHT)
    ref = TableRef("hot", ns)
    create_join(a, c, ref, VIEW)
    feed = join_changes(b, change_feed(a, b, "id"), d, change_feed(c, d, "rid"), VIEW)
    assert feed.groupBy("_change_type").count().count() == 2
    assert rows(refresh_join(ref, b, change_feed(a, b, "id"), d, change_feed(c, d, "rid"), VIEW)) == rows(joined(b, d, VIEW))


def test_changes_of_a_join_feed_an_aggregate(spark):
    a, b = side(spark, {1: (1, "x"), 2: (1, "y")}, LEFT), side(spark, {1: (2, "x"), 3: (1, "x")}, LEFT)
    c, d = side(spark, {1: (1, "p")}, RIGHT), side(spark, {1: (1, "p"), 2: (2, "q")}, RIGHT)
    view = AggregateView("a", sums={"total": "id"})
    feed = join_changes(b, change_feed(a, b, "id"), d, change_feed(c, d, "rid"), VIEW)
    state = apply_changes(aggregate_state(joined(a, c, VIEW), view), feed, view)
    assert rows(aggregate_result(state, view)) == rows(aggregate_result(aggregate_state(joined(b, d, VIEW), view), view))


def test_joins_that_make_no_sense(spark):
    for bad in ({"on": {}}, {"key": []}, {"key": "nowhere"}, {"columns": {"id": ("up", "id"), "rid": ("right", "rid")}}):
        with pytest.raises(ValueError):
            JoinView(**{"on": VIEW.on, "key": VIEW.key, "columns": VIEW.columns, **bad})


SCHEMA = "id bigint, name string, amount bigint"
FIRST = [(1, "a", 10), (2, "b", 20), (3, None, 30), (4, "d", None)]


def made(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_writers_log_what_they_change(spark, ns):
    ref = TableRef("logged", ns)
    log.create_logged(made(spark, FIRST), ref, "id", comment="with a log", properties={"team": "x"})
    assert log.version(spark, ref) == 0 and log.changes_between(spark, ref, 0).count() == 0
    got = log.merge_logged(ref, made(spark, [(2, "b", 21), (3, None, 30), (5, "e", 50), (None, "n", 1)]))
    assert rows(got) == sorted([(1, "a", 10), (2, "b", 21), (3, None, 30), (4, "d", None), (5, "e", 50), (None, "n", 1)], key=repr)
    got = log.update_logged(spark, ref, F.col("amount") > 25, {"amount": F.col("amount") + 1, "name": F.lit("z")})
    assert {r.id: r.amount for r in got.collect()}[5] == 51
    got = log.delete_logged(spark, ref, F.col("id") == 4)
    got = log.overwrite_logged(ref, made(spark, [(6, "z", 6), (3, "z", 31), (1, "z", 1)]), "name")
    assert rows(got) == sorted([(2, "b", 21), (None, "n", 1), (6, "z", 6), (3, "z", 31), (1, "z", 1), (1, "a", 10)], key=repr)
    logged = rows(log.changes_between(spark, ref, 0))
    assert logged == sorted([
        (2, "b", 20, "update_preimage", 1), (2, "b", 21, "update_postimage", 1), (5, "e", 50, "insert", 1), (None, "n", 1, "insert", 1),
        (3, None, 30, "update_preimage", 2), (3, "z", 31, "update_postimage", 2),
        (5, "e", 50, "update_preimage", 2), (5, "z", 51, "update_postimage", 2),
        (4, "d", None, "delete", 3),
        (5, "z", 51, "delete", 4), (6, "z", 6, "insert", 4), (1, "z", 1, "insert", 4)], key=repr)
    assert tables.properties(spark, ref)["team"] == "x"
    assert rows(log.changes_between(spark, ref, 2, 3), "id", "_version") == [(4, 3)]


def test_the_net_of_a_log_is_the_change_feed_of_its_ends(spark, ns):
    ref = TableRef("net", ns)
    log.create_logged(made(spark, FIRST), ref, ["id"])
    log.merge_logged(ref, made(spark, [(2, "b", 21), (9, "gone again", 1)]))
    log.merge_logged(ref, made(spark, [(1, "A", 11), (2, "b", 20)]))
    log.delete_logged(spark, ref, F.col("id").isin(9, 3))
    last = log.merge_logged(ref, made(spark, [(3, "back", 3), (7, "new", 7)]), update_columns="name")
    net = log.net_changes(log.changes_between(spark, ref, 0), "id")
    assert rows(net) == rows(change_feed(made(spark, FIRST), last, "id"))


def test_changes_are_read_from_the_log_alone(spark, ns):
    ref = TableRef("alone", ns)
    log.create_logged(made(spark, FIRST), ref, "id")
    log.merge_logged(ref, made(spark, [(2, "b", 21)]))
    log.merge_logged(ref, made(spark, [(2, "b", 22)]))
    read = log.changes_between(spark, ref, 0)
    assert len(read.inputFiles()) >= 2 and read.count() == 4
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 1 and "Join" not in plan
    assert "PartitionFilters: [isnotnull(__kind" in plan and "changes)" in plan


def test_a_failed_write_leaves_table_and_log(spark, ns):
    ref = TableRef("failing", ns)
    log.create_logged(made(spark, FIRST), ref, "id")
    with pytest.raises(ValueError, match="repeats a key"):
        log.merge_logged(ref, made(spark, [(2, "b", 1), (2, "b", 2)]))
    with pytest.raises(Exception, match="boom"):
        log.update_logged(spark, ref, F.lit(True), {"name": F.raise_error(F.lit("boom")).cast("string")})
    assert log.version(spark, ref) == 0 and rows(spark.table(ref.sql)) == sorted(FIRST, key=repr)
    with pytest.raises(ValueError, match="key"):
        log.update_logged(spark, ref, F.lit(True), {"id": F.lit(1)})
    with pytest.raises(ValueError, match="does not hold"):
        log.changes_between(spark, ref, 0, 3)
    with pytest.raises(ValueError, match="column that the log"):
        log.create_logged(made(spark, FIRST).withColumn("_version", F.lit(1)), ref, "id")
    tables.write_table(made(spark, FIRST), TableRef("plain", ns))
    with pytest.raises(ValueError, match="no change log"):
        log.version(spark, TableRef("plain", ns))


def test_empty_versions(spark, ns):
    ref = TableRef("empty", ns)
    assert log.create_logged(made(spark, []), ref, "id").count() == 0
    assert log.merge_logged(ref, made(spark, [])).count() == 0
    assert log.merge_logged(ref, made(spark, FIRST)).count() == 4
    assert log.delete_logged(spark, ref, F.lit(True)).count() == 0
    assert log.net_changes(log.changes_between(spark, ref, 0), "id").count() == 0
    assert log.version(spark, ref) == 3


def test_the_cheapest_refresh_is_chosen(spark, ns):
    source, other, view = TableRef("source", ns), TableRef("other", ns), TableRef("view", ns)
    totals = AggregateView("name", sums={"total": "amount"})
    log.create_logged(made(spark, FIRST), source, "id")
    log.create_logged(made(spark, FIRST), other, "id")

    def run(**options):
        return refresh(spark, view, {"s": source}, lambda r: aggregate_state(r["s"], totals),
                       **{"incremental": lambda state, feeds, _: apply_changes(state, feeds["s"], totals), **options})

    def right():
        return rows(aggregate_result(spark.table(view.sql), totals)) == rows(aggregate_result(aggregate_state(spark.table(source.sql), totals), totals))

    assert run() == "full" and right()
    spark.sparkContext.setJobGroup("skip", "a refresh with nothing to do")
    assert run() == "skipped"
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("skip")
    spark.sparkContext.setJobGroup("other", "")
    log.merge_logged(source, made(spark, [(1, "b", 1), (8, "h", 8)]))
    log.delete_logged(spark, source, F.col("id") == 2)
    assert run() == "incremental" and right() and run() == "skipped"
    log.delete_logged(spark, source, F.col("id") == 8)
    assert run(incremental=lambda *_: None) == "full" and right()
    log.delete_logged(spark, source, F.col("id") == 3)
    log.merge_logged(source, made(spark, [(3, "c", 3)]))
    log.forget_before(spark, source, log.version(spark, source))  # the log no longer covers the gap
    assert run() == "full" and right()
    assert refresh(spark, view, {"s": source, "o": other}, lambda r: aggregate_state(r["s"], totals)) == "full"
    assert len(held_versions(spark, view)) == 2 and held_versions(spark, TableRef("nothing", ns)) == {}
    tables.rewrite(tables.fresh(spark, view), view)  # a rewrite keeps what the view holds
    assert refresh(spark, view, {"s": source, "o": other}, lambda r: None) == "skipped"
