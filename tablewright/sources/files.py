"""Tables read from files or from the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright import tables
from tablewright.naming import TableRef


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def source(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """A declared raw table."""
    return spark.table(TableRef(name, namespace).sql)


def find_table(spark: SparkSession, name: str) -> TableRef | None:
    """The first namespace, in order of name, that has a table of this name."""
    for db in sorted(d.name for d in spark.catalog.listDatabases()):
        ref = TableRef(name, db)
        if tables.table_kind(spark, ref):
            return ref
    return None
