from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tablewright import Storage, TableRef, tables
from tablewright.operators import incremental as inc
from tablewright.operators.merge import merge, merge_into

FIRST = [(11, "oak"), (12, "elm"), (14, "ash")]
SECOND = [(12, "fir"), (15, "yew"), (16, "box")]
UPSERTED = [(11, "oak"), (12, "fir"), (14, "ash"), (15, "yew"), (16, "box")]
ZONED = [(1, "oak", "hill"), (2, "elm", "shore"), (4, "ash", "hill")]
SCHEMA, SCHEMA3 = "id bigint, note string", "id bigint, note string, zone string"


def made(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


@pytest.fixture(params=["plain", "by_id"])
def started(request, spark, ns):
    ref = TableRef("model", ns)
    tables.write_table(made(spark, FIRST), ref, Storage(partition_by="id" if request.param == "by_id" else None))
    return ref, request.param


def test_append_keeps_copies(spark, started):
    ref, _ = started
    assert rows(inc.append(ref, made(spark, SECOND)), "id", "note") == sorted(FIRST + SECOND, key=repr)


def test_overwrite_replaces_all_or_the_partitions_of_the_batch(spark, started):
    ref, layout = started
    kept = [(11, "oak"), (14, "ash")] if layout == "by_id" else []
    assert rows(inc.insert_overwrite(ref, made(spark, SECOND)), "id", "note") == sorted(kept + SECOND, key=repr)


def test_merge_on_key(spark, started):
    ref, _ = started
    assert rows(merge_into(ref, made(spark, SECOND), "id"), "id", "note") == UPSERTED


@pytest.mark.parametrize("key", [None, "", []])
def test_merge_without_key_adds_everything(spark, started, key):
    ref, _ = started
    assert rows(merge_into(ref, made(spark, SECOND), key), "id", "note") == sorted(FIRST + SECOND, key=repr)


def test_update_only_some_columns(spark):
    batch = made(spark, [(2, "fir", "town"), (5, "yew", "town")], SCHEMA3)
    result = merge(made(spark, ZONED, SCHEMA3), batch, "id", update_columns=["note"])
    assert rows(result) == [(1, "oak", "hill"), (2, "fir", "shore"), (4, "ash", "hill"), (5, "yew", "town")]


BATCH3 = [(1, "box", "hill"), (2, "fir", "town"), (5, "yew", "town")]


def test_exclude_columns_ignores_case(spark):
    result = merge(made(spark, ZONED, SCHEMA3), made(spark, BATCH3, SCHEMA3), "id", exclude_columns=["NOTE"])
    assert rows(result) == [(1, "oak", "hill"), (2, "elm", "town"), (4, "ash", "hill"), (5, "yew", "town")]


@pytest.mark.parametrize("predicate, aliases", [
    ("target.id != 2", ("target", "source")),
    ("source.id != 2", ("target", "source")),
    ("old_row.id + new_row.id <> 4", ("old_row", "new_row")),
])
def test_predicate_leaves_the_row_unmatched(spark, predicate, aliases):
    result = merge(made(spark, ZONED, SCHEMA3), made(spark, BATCH3, SCHEMA3), "id",
                   predicates=[predicate], aliases=aliases)
    assert rows(result) == [
        (1, "box", "hill"), (2, "elm", "shore"), (2, "fir", "town"), (4, "ash", "hill"), (5, "yew", "town")]


def test_predicate_that_is_null_does_not_match(spark):
    target = made(spark, [(1, "a", None), (2, "b", "x")], SCHEMA3)
    batch = made(spark, [(1, "A", "y"), (2, "B", "y")], SCHEMA3)
    result = merge(target, batch, "id", predicates="target.zone = 'x'")
    assert rows(result) == sorted([(1, "a", None), (1, "A", "y"), (2, "B", "y")], key=repr)


def test_both_lists_are_refused(spark):
    with pytest.raises(ValueError, match="not both"):
        merge(made(spark, ZONED, SCHEMA3), made(spark, BATCH3, SCHEMA3), "id",
              update_columns="note", exclude_columns="zone")


# -------------------------------------------------------------- unique keys

DOCKS = [
    ("east", "mill", 4, date(2031, 3, 8)), ("east", "quay", 1, date(2031, 3, 2)), ("north", "yard", 7, date(2030, 12, 30)),
    ("south", "quay", 2, date(2031, 1, 19)),
]
DOCK_SCHEMA = "zone string, site string, dock int, checked date"
CHECKED = ("north", "yard", 7, date(2031, 4, 1))
BUILT = [("west", "quay", 1, date(2031, 5, 5)), ("upper", "mill", 9, date(2031, 5, 6)), ("lower", "mill", 9, None)]


@pytest.mark.parametrize("key", ["zone", ["zone"], ["zone", "zone"], ["zone", "site", "dock"]])
def test_new_docks_are_added(spark, key):
    result = merge(made(spark, DOCKS, DOCK_SCHEMA), made(spark, BUILT, DOCK_SCHEMA), key)
    assert rows(result) == sorted(DOCKS + BUILT, key=repr)


@pytest.mark.parametrize("key", ["zone", ["zone", "zone"], ["dock", "site", "zone"]])
def test_a_known_dock_is_updated(spark, key):
    result = merge(made(spark, DOCKS, DOCK_SCHEMA), made(spark, [CHECKED], DOCK_SCHEMA), key)
    assert rows(result) == sorted([CHECKED, *DOCKS[:2], DOCKS[3]], key=repr)


def test_unknown_key_is_named(spark, ns):
    ref = TableRef("docks", ns)
    tables.write_table(made(spark, DOCKS, DOCK_SCHEMA), ref)
    with pytest.raises(ValueError, match="nowhere"):
        merge_into(ref, made(spark, BUILT, DOCK_SCHEMA), ["zone", "nowhere"])


def test_one_batch_row_may_update_many(spark):
    target = made(spark, [(1, "a"), (1, "b"), (2, "c")])
    assert rows(merge(target, made(spark, [(1, "z")]), "id")) == [(1, "z"), (1, "z"), (2, "c")]


def test_batch_derived_from_its_target(spark, request):
    for way in ("broadcast", "shuffled"):
        if way == "shuffled":
            request.getfixturevalue("shuffled")
        target = made(spark, FIRST + [(None, "n")])
        batch = target.filter("id = 12 or id is null").withColumn("note", F.lit("again"))
        for predicates in (None, "target.note <> source.note"):
            assert rows(merge(target, batch, "id", predicates=predicates)) == sorted(
                [(11, "oak"), (12, "again"), (14, "ash"), (None, "n"), (None, "again")], key=repr)


def test_null_keys_are_added(spark):
    target = made(spark, [(None, "a"), (1, "b")])
    result = merge(target, made(spark, [(None, "x"), (None, "y")]), "id")
    assert rows(result) == sorted([(None, "a"), (1, "b"), (None, "x"), (None, "y")], key=repr)


@pytest.mark.parametrize("way", ["broadcast", "shuffled"])
def test_repeated_batch_key(spark, way, request):
    if way == "shuffled":
        request.getfixturevalue("shuffled")
    target = made(spark, FIRST)
    result = merge(target, made(spark, [(7, "a"), (7, "b"), (12, "fir"), (8, "c")]), "id")
    assert rows(result) == [(11, "oak"), (12, "fir"), (14, "ash"), (7, "a"), (7, "b"), (8, "c")]
    with pytest.raises(ValueError, match="same target row"):
        merge(target, made(spark, [(12, "a"), (12, "b")]), "id")


def test_repeated_match_through_a_two_sided_condition_fails(spark):
    target, batch = made(spark, [(1, "m")]), made(spark, [(1, "a"), (1, "b")])
    with pytest.raises(Exception, match="same target row"):
        merge(target, batch, "id", predicates="source.note < target.note").collect()
    chosen = merge(target, made(spark, [(1, "a"), (1, "z")]), "id", predicates="source.note < target.note")
    assert rows(chosen) == [(1, "a"), (1, "z")]


def test_extra_batch_columns_are_left_out_and_missing_ones_refused(spark, ns):
    ref = TableRef("model", ns)
    tables.write_table(made(spark, FIRST), ref)
    inc.append(ref, made(spark, [(9, "x", "town")], SCHEMA3))
    assert (9, "x") in rows(spark.table(ref.sql))
    with pytest.raises(ValueError, match="note"):
        inc.append(ref, spark.createDataFrame([(1,)], "id bigint"))


@pytest.mark.parametrize("write", [
    inc.append, inc.insert_overwrite, lambda ref, batch: merge_into(ref, batch, "id"),
    lambda ref, batch: inc.replace_partitions(ref, batch, "id"),
])
def test_the_table_keeps_its_types(spark, ns, write):
    ref = TableRef("typed", ns)
    tables.write_table(made(spark, FIRST), ref)
    batch = spark.createDataFrame([("5", 2)], "note string, id int")
    assert write(ref, batch).dtypes == [("id", "bigint"), ("note", "string")]
    assert (2, "5") in rows(spark.table(ref.sql))


def test_partition_move_clears_the_old_partition(spark, ns):
    ref = TableRef("moving", ns)
    tables.write_table(made(spark, [(1, "a"), (2, "a"), (3, "b"), (4, "c")]), ref, Storage(partition_by="note"))
    moved = merge_into(ref, made(spark, [(3, "a"), (2, "c")]), "id")
    assert rows(moved, "id", "note") == [(1, "a"), (2, "c"), (3, "a"), (4, "c")]
    # What was cleared stays cleared when the partition gets rows again.
    assert rows(inc.append(ref, made(spark, [(5, "b")])), "id", "note") == [
        (1, "a"), (2, "c"), (3, "a"), (4, "c"), (5, "b")]


def test_partition_move_with_null_partition(spark, ns):
    ref = TableRef("moving", ns)
    tables.write_table(made(spark, [(1, None), (2, "a")]), ref, Storage(partition_by="note"))
    assert rows(merge_into(ref, made(spark, [(1, "a")]), "id"), "id", "note") == [(1, "a"), (2, "a")]
    assert rows(merge_into(ref, made(spark, [(2, None)]), "id"), "id", "note") == sorted(
        [(1, "a"), (2, None)], key=repr)


def test_partitioned_merge_leaves_other_files_alone(spark, ns):
    ref = TableRef("part", ns)
    tables.write_table(made(spark, [(1, "a"), (2, "b")]), ref, Storage(partition_by="note"))
    files = lambda: {r[0] for r in spark.table(ref.sql).filter("note = 'b'").select("_metadata.file_path").collect()}
    before = files()
    merge_into(ref, made(spark, [(1, "a"), (7, "a")]), "id")
    assert files() == before


# -------------------------------------------------------------- replace, micro-batches, watermark

def test_replace_partitions_treats_null_as_a_value(spark, ns):
    schema = "id bigint, day string"
    for layout in (None, "day"):
        ref = TableRef(f"r_{layout}", ns)
        tables.write_table(spark.createDataFrame([(1, None), (2, "a"), (3, "b")], schema), ref,
                           Storage(partition_by=layout))
        batch = spark.createDataFrame([(4, None), (5, "a")], schema)
        for _ in range(2):  # again changes nothing
            assert rows(inc.replace_partitions(ref, batch, "day"), "id", "day") == sorted(
                [(4, None), (5, "a"), (3, "b")], key=repr)


def test_replace_partitions_on_another_layout(spark, ns):
    ref = TableRef("other", ns)
    tables.write_table(made(spark, [(1, "a"), (2, "b")]), ref, Storage(partition_by="id"))
    assert rows(inc.replace_partitions(ref, made(spark, [(9, "b")]), "note"), "id", "note") == [(1, "a"), (9, "b")]


@pytest.mark.parametrize("rowwise", [False, True])
def test_microbatches_pick_up_what_lies_in_their_slices(spark, ns, rowwise):
    schema = "id bigint, seen_at timestamp_ntz"
    early = [(i, datetime(2031, 8, i, i)) for i in range(10, 15)]
    late = [(30, datetime(2031, 8, 12, 23, 59)), (31, datetime(2031, 8, 20))]
    ref = TableRef("micro", ns)

    def run(data, first, last):
        table = inc.microbatch(
            ref, spark.createDataFrame(data, schema), lambda d: d.withColumn("seen_on", F.to_date("seen_at")),
            event_time="seen_at", batch_size="day", begin=datetime(2031, 8, first, 7), end=datetime(2031, 8, last, 1),
            partition_by="seen_on", rowwise=rowwise)
        return [r[0] for r in rows(table, "id")]

    assert run(early, 10, 12) == [10, 11, 12]
    assert run(early, 10, 12) == [10, 11, 12]
    assert run(early + late, 13, 14) == [10, 11, 12, 13, 14]
    assert run(early + late, 12, 13) == [10, 11, 12, 13, 14, 30]


@pytest.mark.parametrize("rowwise", [False, True])
def test_slices_finer_than_a_partition_are_all_kept(spark, ns, rowwise):
    source = spark.createDataFrame([(i, datetime(2031, 9, i)) for i in (2, 3, 20)], "id bigint, seen_at timestamp_ntz")
    table = None
    for _ in range(2):  # into a new table, then into the partition
        table = inc.microbatch(
            TableRef("coarse", ns), source, lambda d: d.withColumn("month", F.date_trunc("month", "seen_at").cast("date")),
            event_time="seen_at", batch_size="day", begin=datetime(2031, 9, 1), end=datetime(2031, 9, 30),
            partition_by="month", rowwise=rowwise)
    assert [r[0] for r in rows(table, "id")] == [2, 20, 3]


@pytest.mark.parametrize("rowwise", [False, True])
def test_rows_outside_the_slices_stay(spark, ns, rowwise):
    """Days within one month's partition, and a neighbouring month that a slice reaches into."""
    ref, schema = TableRef("ranges", ns), "id bigint, seen_at timestamp_ntz"
    at = [(1, datetime(2032, 1, 1, 5)), (2, datetime(2032, 1, 3)), (3, datetime(2032, 1, 4, 23)), (4, datetime(2032, 1, 5)), (5, datetime(2032, 2, 1))]

    def run(data, first, last, **options):
        table = inc.microbatch(
            ref, spark.createDataFrame(data, schema), lambda d: d.withColumn("month", F.date_trunc("month", "seen_at").cast("date")),
            event_time="seen_at", batch_size="day", begin=first, end=last, partition_by="month", rowwise=rowwise, **options)
        return [r[0] for r in rows(table, "id")]

    assert run(at, datetime(2032, 1, 1), datetime(2032, 2, 2)) == [1, 2, 3, 4, 5]
    tables.append_rows(spark.createDataFrame([(9, None, None)], schema + ", month date"), ref)  # without an event time
    for _ in range(2):
        assert run(at, datetime(2032, 1, 3), datetime(2032, 1, 4, 1)) == [1, 2, 3, 4, 5, 9]
    assert run([(3, datetime(2032, 1, 4, 2))], datetime(2032, 1, 3), datetime(2032, 1, 4, 1)) == [1, 3, 4, 5, 9]
    assert run([], datetime(2032, 2, 1), datetime(2032, 2, 1, 1)) == [1, 3, 4, 9]  # the last row of its partition
    assert {str(r[0]) for r in rows(spark.sql(f"show partitions {ref.sql}"))} >= {"month=2032-01-01"}
    assert "month=2032-02-01" not in {r[0] for r in rows(spark.sql(f"show partitions {ref.sql}"))}


def test_slices_of_a_model_without_the_event_time(spark, ns):
    ref = TableRef("sums", ns)
    source = spark.createDataFrame([(i, datetime(2033, 1, i)) for i in (1, 2, 3)], "id bigint, seen_at timestamp_ntz")

    def run(**options):
        return inc.microbatch(
            ref, source, lambda d: d.groupBy(F.to_date("seen_at").alias("day")).agg(F.sum("id").alias("total")), event_time="seen_at",
            batch_size="day", begin=datetime(2033, 1, 1), end=datetime(2033, 1, 3, 1), partition_by="day", **options)

    assert run().count() == 3
    with pytest.raises(ValueError, match="has no column 'seen_at'"):
        run()
    assert rows(run(whole_partitions=True), "total") == [(1,), (2,), (3,)]


def test_slices():
    assert inc.slices(datetime(2020, 11, 15), datetime(2021, 1, 1), "month") == [
        (datetime(2020, 11, 1), datetime(2020, 12, 1)), (datetime(2020, 12, 1), datetime(2021, 1, 1))]
    assert len(inc.slices(datetime(2020, 1, 1, 5, 30), datetime(2020, 1, 1, 8, 1), "hour")) == 4
    assert inc.slices(datetime(2020, 5, 1), datetime(2021, 1, 2), "year")[-1][1] == datetime(2022, 1, 1)
    with pytest.raises(ValueError):
        inc.slices(datetime(2020, 1, 1), datetime(2020, 1, 2), "fortnight")


def test_watermark_prunes_at_the_scan(spark, ns, tmp_path):
    ref = TableRef("marked", ns)
    source = spark.range(100).withColumnRenamed("id", "k")
    source.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    assert inc.high_watermark(spark, source, ref, "k").count() == 100
    tables.write_table(source.filter("k < 60"), ref)
    new = inc.high_watermark(spark, source, ref, "k")
    assert "GreaterThan(k,59)" in new._jdf.queryExecution().toString()
    assert inc.append(ref, new).count() == 100


# -------------------------------------------------------------- the whole run

def test_validate_incremental():
    assert inc.validate_incremental(None, "parquet") == "append"
    for strategy, fmt in (("append", "orc"), ("upsert", "parquet"), ("merge", "csv"), ("microbatch", "parquet"), ("merge", "delta")):
        with pytest.raises(ValueError):
            inc.validate_incremental(strategy, fmt)


def test_build_runs_hooks_and_strategies(spark, ns):
    ref, seen = TableRef("built", ns), []

    def model(is_incremental):
        seen.append(is_incremental)
        return made(spark, SECOND if is_incremental else FIRST)

    def build(**options):
        return rows(inc.build_incremental(
            spark, ref, model, strategy="merge", unique_key="id",
            pre=[lambda: seen.append("pre")], post=[lambda: seen.append("post")], **options))

    assert build() == sorted(FIRST)
    assert build() == UPSERTED
    assert build(full_refresh=True) == sorted(FIRST)
    tables.drop(spark, ref)
    tables.materialize_view(spark, "SELECT 1 AS id", ref)
    assert build() == sorted(FIRST)
    assert seen == ["pre", False, "post", "pre", True, "post", "pre", False, "post", "pre", False, "post"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    old=st.dictionaries(st.integers(0, 12), st.sampled_from("abc"), max_size=10),
    new=st.dictionaries(st.integers(0, 12), st.sampled_from("xyz"), min_size=1, max_size=10),
)
def test_merge_is_an_upsert_and_idempotent(spark, old, new):
    target, batch = made(spark, list(old.items())), made(spark, list(new.items()))
    once = merge(target, batch, "id")
    assert dict(rows(once)) == {**old, **new}
    assert rows(merge(once, batch, "id")) == rows(once)


def test_hot_key_against_brute_force(spark, shuffled):
    """A third of the target has one key; the batch has it once and another new key many times."""
    target = spark.range(3000).select(
        F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("id"), F.lit("old").alias("note"))
    batch = made(spark, [(7, "new")]).union(
        spark.range(500).select(F.lit(-1).cast("bigint"), F.lit("added"))).union(made(spark, [(2000, "two")]))
    counted = {(r[0], r[1]): r[2] for r in merge(target, batch, "id").groupBy("id", "note").count().collect()}
    expected = {(7, "new"): 1000, (-1, "added"): 500, (2000, "two"): 1}
    expected |= {(i, "old"): 1 for i in range(1000, 3000) if i != 2000}
    assert counted == expected


def test_a_large_merge_never_needs_a_full_outer_join(spark, shuffled):
    plan = merge(made(spark, FIRST), made(spark, SECOND), "id")._jdf.queryExecution().toString()
    assert "FullOuter" not in plan and "LeftOuter" in plan and "BroadcastHashJoin" not in plan
