"""Merges that rewrite only the buckets of their keys."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright import Storage, TableRef, tables
from tablewright.operators.buckets import BUCKET, bucket_key, create_bucketed, merge_bucketed


def test_a_merge_rewrites_the_buckets_of_its_keys(spark, ns):
    ref = TableRef("wide", ns)
    create_bucketed(spark.range(2000).select("id", (F.col("id") * 2).alias("v")), ref, "id", 64, Storage(properties={"team": "x"}))
    before = set(spark.table(ref.sql).inputFiles())
    # Ten keys, as int where the table has bigint: five known, five new.
    batch = spark.range(1995, 2005).select(F.col("id").cast("int").alias("id"), F.lit(-1).alias("v"))
    got = merge_bucketed(ref, batch)
    after = set(got.inputFiles())
    touched = {r[0] for r in got.filter("v = -1").select(BUCKET).distinct().collect()}
    assert 1 < len(touched) <= 10
    folder = lambda files: {f.rsplit("/", 2)[1] for f in files}
    assert folder(before - after) <= {f"{BUCKET}={b}" for b in touched} and len(before & after) >= 64 - 10
    assert rows(got.drop(BUCKET)) == sorted([(i, i * 2) for i in range(1995)] + [(i, -1) for i in range(1995, 2005)], key=repr)
    assert bucket_key(spark, ref) == (["id"], 64) and tables.properties(spark, ref)["team"] == "x"


def test_keys_of_several_columns_and_null(spark, ns):
    ref, schema = TableRef("pairs", ns), "a string, b int, v int"
    create_bucketed(spark.createDataFrame([("x", 1, 1), ("x", 2, 2), (None, 3, 3)], schema), ref, ["a", "b"], 4)
    got = merge_bucketed(ref, spark.createDataFrame([("x", 2, 20), (None, 3, 30), ("y", 1, 4)], schema), update_columns="v")
    assert rows(got, "a", "b", "v") == sorted([("x", 1, 1), ("x", 2, 20), (None, 3, 3), (None, 3, 30), ("y", 1, 4)], key=repr)
    with pytest.raises(ValueError, match="more than one"):
        merge_bucketed(ref, spark.createDataFrame([("x", 1, 5), ("x", 1, 6)], schema))


def test_tables_that_cannot_be_bucketed(spark, ns):
    df = spark.range(3)
    for args, storage in ((([], 4), Storage()), (("id", 0), Storage()), (("id", 2), Storage(partition_by="id"))):
        with pytest.raises(ValueError):
            create_bucketed(df, TableRef("bad", ns), *args, storage)
    with pytest.raises(ValueError, match="already"):
        create_bucketed(df.withColumn(BUCKET, F.lit(1)), TableRef("bad", ns), "id", 2)
    tables.write_table(df, TableRef("plain", ns))
    with pytest.raises(ValueError, match="not bucketed"):
        merge_bucketed(TableRef("plain", ns), df)
