"""Comparisons by checksums of key ranges."""

from pyspark.sql import functions as F

from conftest import rows
from tablewright.operators.checks import relations_equal
from tablewright.operators.digests import differing_ranges, range_digests, relations_equal_by_ranges


def both(a, b, **options):
    got = relations_equal_by_ranges(a, b, **options)
    assert rows(got) == rows(relations_equal(a, b)) and got.schema == relations_equal(a, b).schema
    return got.first()


def test_equal_tables_in_another_order_and_type(spark):
    a = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("v"))
    b = a.orderBy(F.desc("id")).repartition(7).select("v", F.col("id").cast("int").alias("id"))
    assert differing_ranges(a, b) == [] and tuple(both(a, b)) == (0, 0)
    assert tuple(both(a.limit(0), b.limit(0))) == (0, 0)


def test_only_differing_ranges_are_compared(spark):
    a = spark.range(3000).select("id", (F.col("id") * 2).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v"))).filter("id <> 1234")
    assert len(differing_ranges(a, b, key="id")) == 2
    assert tuple(both(a, b, key="id")) == (1, 3) and tuple(both(a, b, ranges=5)) == (1, 3)
    assert tuple(both(b, a.limit(0))) == (2999, 2999)


def test_copies_nulls_and_maps(spark):
    a = spark.createDataFrame([(1, None), (1, None), (None, {"x": 1, "y": 2})], "k int, m map<string,int>")
    b = spark.createDataFrame([(1, None), (None, {"y": 2, "x": 1})], "k int, m map<string,int>")
    assert tuple(both(a, b)) == (1, 0) and tuple(both(a, b.union(b.limit(1)))) in {(0, 0)}
    assert differing_ranges(a, a.repartition(3), columns=["m"]) == []


def test_checksums_are_summed_before_the_shuffle(spark, tmp_path):
    spark.range(1000).select("id", F.col("id").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = range_digests(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_sum") > plan.index("Exchange")
