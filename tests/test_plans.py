"""Plans that must hold at any scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablewright import Storage, TableRef, tables
from tablewright.operators import checks
from tablewright.operators.merge import merge
from tablewright.operators.snapshot import SnapshotConfig, snapshot, snapshot_init, snapshot_step
from tablewright.operators.views import change_feed
from tablewright.sizes import BROADCAST_LIMIT, fits_broadcast, proven_bytes

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(spark, name):
    return entry.queries()[name](spark, FOLDER)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(run(spark, "rel_filter"))
    assert "PushedFilters: [IsNotNull(o_orderdate)" in text and "GreaterThan(o_totalprice,1000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_joins_of_the_project_meet_reduced_sides(spark):
    text = plan(run(spark, "rel_customers"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    assert text.count("partial_") >= 2


def test_no_query_uses_python_workers_or_cross_joins(spark):
    lazy = [n for n in entry.queries() if n.startswith(("fn_", "rel_", "agg_", "test_", "constraint", "scd", "change"))]
    for name in lazy:
        text = plan(run(spark, name))
        assert not re.search("ArrowEval|BatchEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoop", text), name


def test_bucketed_tables_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(run(spark, "table_bucketed"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Exchange" not in text and "SelectedBucketsCount: 8 out of 8" in text


def test_a_small_batch_leaves_the_target_unshuffled(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id as v")
    rows.write.parquet(str(tmp_path / "target"))
    rows.filter("id < 3").write.parquet(str(tmp_path / "batch"))
    target, batch = (spark.read.parquet(str(tmp_path / side)) for side in ("target", "batch"))
    text = plan(merge(target, batch, "id"))
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text
    # The only shuffle is that of the matched keys.
    assert text.count("Exchange hashpartitioning") == 1


def test_a_predicate_on_the_target_reaches_its_scan(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id as v")
    rows.write.parquet(str(tmp_path / "target"))
    rows.filter("id < 3").write.parquet(str(tmp_path / "batch"))
    target, batch = (spark.read.parquet(str(tmp_path / side)) for side in ("target", "batch"))
    assert "GreaterThan(v,900)" in plan(merge(target, batch, "id", predicates="target.v > 900"))


@pytest.fixture
def eager_splitting(spark):
    """Skew handling at toy sizes."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(spark):
    """40,000 rows, a third of them with one key."""
    return spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") < 13333, 0).otherwise(F.col("id")).alias("id"), F.md5(F.col("id").cast("string")).alias("v"))


def test_a_hot_target_key_is_split(spark, eager_splitting, shuffled):
    batch = spark.range(0, 40000, 1, 4).selectExpr("id", "cast(id as string) as v")
    result = merge(hot(spark), batch, "id")
    got = result.groupBy().agg(F.count("*"), F.sum(F.when((F.col("id") == 0) & (F.col("v") == "0"), 1))).first()
    assert tuple(got) == (40000 + 13333 - 1, 13333)
    result.collect()
    assert "skew=true" in plan(result)


def test_a_hot_child_key_is_split(spark, eager_splitting):
    orphans = checks.relationships(hot(spark), "id", spark.range(20000, 30000).toDF("id"), "id")
    assert orphans.count() == 30000


def test_a_hot_partition_is_written_by_several_tasks(spark, ns, eager_splitting):
    ref = TableRef("skewed", ns)
    table = tables.write_table(hot(spark).withColumn("p", (F.col("id") > 0).cast("int")), ref, Storage(partition_by="p"))
    files = {r.p: r.n for r in table.groupBy("p").agg(F.countDistinct("_metadata.file_path").alias("n")).collect()}
    assert files[0] > 1 and table.count() == 40000


def test_change_feed_shuffles_each_side_once(spark, shuffled):
    state = spark.range(100).selectExpr("id", "id as v")
    text = change_feed(state, state.filter("id > 3"), "id")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


def test_only_proven_sizes_count_as_small(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert 0 < proven_bytes(stored.filter("id > 3")) < BROADCAST_LIMIT
    assert fits_broadcast(stored) and not fits_broadcast(stored, 10)
    grown = stored.select(F.explode(F.sequence(F.lit(1), F.col("id"))))
    assert proven_bytes(grown) is None and not fits_broadcast(grown)
    assert not fits_broadcast(stored.join(stored.withColumnRenamed("id", "x"), F.col("x") == F.col("id")))


def test_compressible_rows_are_measured_before_a_broadcast(spark, tmp_path):
    """Files of some kilobytes that hold 40 MB."""
    folder = str(tmp_path / "t")
    spark.range(40000).select("id", F.repeat(F.lit("x"), 1000).alias("v")).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert proven_bytes(stored) < BROADCAST_LIMIT and not fits_broadcast(stored)
    assert fits_broadcast(stored.select("id")) and not fits_broadcast(stored.select("id", F.array("v")))
    target = spark.range(100).select("id", F.lit("y").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = merge(target, stored, "id")
        # Only the keys of the batch, which are small, are sent to all.
        assert plan(result).count("BroadcastHashJoin") <= 1 and "SortMergeJoin" in plan(result)
        assert result.count() == 40000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_snapshot_shuffles_each_side_once(spark, shuffled):
    config = SnapshotConfig("id", "check", check_cols="all", hard_deletes="invalidate")
    history = snapshot_init(spark.range(100).selectExpr("id", "id as v"), config, "2024-01-01 00:00:00")
    history = spark.createDataFrame(history.collect(), history.schema)
    text = plan(snapshot_step(history, spark.range(50).selectExpr("id", "-id as v"), config, "2024-02-01 00:00:00").moved)
    assert text.count("Exchange hashpartitioning") == 2 and text.count("SortMergeJoin") == 1


def test_a_bucketed_history_is_not_shuffled(spark, ns, shuffled):
    config = SnapshotConfig("id", "check", check_cols="all")
    ref = TableRef("history", ns)
    snapshot(spark.range(100).selectExpr("id", "id as v"), ref, config, "2024-01-01 00:00:00",
             Storage(clustered_by="id", buckets=6))
    source = spark.range(50).selectExpr("id", "-id as v")
    text = plan(snapshot_step(spark.table(ref.sql), source.repartition(6, "id"), config, "2024-02-01 00:00:00").moved)
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(id" in text
    after = snapshot(source, ref, config, "2024-02-01 00:00:00")
    assert after.count() == 149 and tables.storage_of(spark, ref).buckets == 6
