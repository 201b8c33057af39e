"""Old versions: what no table reads is emptied, everything else stays."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright import Storage, TableRef, tables
from tablewright.operators.changelog import create_logged
from tablewright.operators.cleanup import drop_old_versions, old_versions


def test_old_versions(spark, ns):
    ref, copy, parts, theirs = (TableRef(n, ns) for n in ("t", "copy", "parts", "theirs"))
    data = spark.range(6).selectExpr("id", "id % 3 as p")
    tables.write_table(data, ref)
    first = tables.location(spark, ref)
    tables.clone(spark, ref, copy)
    for n in (1, 2):
        tables.rewrite(data.withColumn("id", F.col("id") + n), ref)
    # The clone still reads the first version, of which the rewritten table knows nothing any more.
    assert tables.sharers(spark, ref) == [] and tables.location(spark, copy) == first
    assert old_versions(spark, ref, hours=1).isEmpty()
    (gone,) = drop_old_versions(spark, ref, hours=0)
    assert gone != first and drop_old_versions(spark, ref, hours=0) == []
    assert rows(spark.table(copy.sql)) == rows(data)
    assert rows(spark.table(ref.sql), "id") == [(i + 2,) for i in range(6)]
    tables.drop(spark, copy)
    assert len(drop_old_versions(spark, ref, hours=0)) == 1 and spark.table(ref.sql).count() == 6
    # Partitions that were moved twice: the directory of the first move is no longer read.
    tables.write_table(data, parts, Storage(partition_by="p"))
    tables.clone(spark, parts, theirs)
    for n in (10, 20):
        tables.overwrite_partitions(data.filter("p = 1").withColumn("id", F.col("id") * 0 + n), theirs)
    assert len(drop_old_versions(spark, theirs, hours=0)) == 1 and drop_old_versions(spark, parts, hours=0) == []
    assert rows(spark.table(theirs.sql), "id") == [(0,), (2,), (20,), (20,), (3,), (5,)]
    assert rows(spark.table(parts.sql)) == rows(data)
    # What its readers may still ask for.
    create_logged(data, TableRef("logged", ns), "id")
    with pytest.raises(ValueError, match="logs its changes"):
        old_versions(spark, f"{ns}.logged")
