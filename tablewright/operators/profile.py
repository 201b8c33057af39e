"""What the catalog knows about tables, and the DDL around it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.naming import TableRef, quote, resolve_columns, sql_text


def columns_in(spark: SparkSession, ref: TableRef | str) -> list[tuple[str, str]]:
    """Ordered (name, type) pairs; none for a table that does not exist."""
    ref = TableRef.parse(ref)
    if tables.table_kind(spark, ref) is None:
        return []
    return [(f.name, f.dataType.simpleString()) for f in spark.table(ref.sql).schema]


def column_profile(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: name, type, position and how many values it has, in one pass."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(quote(n))).alias(f"__c{i}") for i, n in enumerate(names)],
    )
    entries = F.array(*[
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(i + 1).alias("column_index"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("__rows").alias("row_count"),
            F.col(f"__c{i}").alias("non_null"),
        ) for i, f in enumerate(df.schema)])
    return counted.select(F.explode(entries).alias("e")).select("e.*")


def row_count(df: DataFrame, table_name: str) -> DataFrame:
    """One row with the exact number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table_name).alias("table_name"), "row_count")


def table_stats(spark: SparkSession, ref: TableRef | str) -> dict[str, int]:
    """Bytes and rows of a stored table, computed by Spark and kept in the catalog."""
    ref = TableRef.parse(ref)
    spark.sql(f"ANALYZE TABLE {ref.sql} COMPUTE STATISTICS")
    return parse_statistics(tables.describe(spark, ref)[1].get("Statistics", ""))


def parse_statistics(text: str) -> dict[str, int]:
    """``"1234 bytes, 56 rows"`` as numbers; either part may be absent."""
    result = {}
    for part in text.split(","):
        number, _, unit = part.strip().partition(" ")
        if unit in ("bytes", "rows") and number.isdigit():
            result[unit] = int(number)
    return result


def list_tables(spark: SparkSession, namespace: str) -> list[dict[str, str | None]]:
    """Name, type and format of the stored tables and views; none for a missing namespace."""
    if not spark.catalog.databaseExists(quote(namespace)):
        return []
    found = []
    for t in spark.catalog.listTables(quote(namespace)):
        if t.isTemporary:
            continue
        ref = TableRef(t.name, namespace)
        kind = tables.table_kind(spark, ref)
        fmt = tables.describe(spark, ref)[1].get("Provider") if kind == "table" else None
        found.append({"name": t.name, "type": kind, "format": fmt.lower() if fmt else None})
    return sorted(found, key=lambda t: t["name"])


def catalog(spark: SparkSession, namespace: str) -> DataFrame:
    """One row per column of every table and view of a namespace, with row counts."""
    parts = []
    for t in list_tables(spark, namespace):
        ref = TableRef(t["name"], namespace)
        comments = {c.name: c.description for c in spark.catalog.listColumns(ref.sql)}
        owner = tables.describe(spark, ref)[1].get("Owner")
        about = F.create_map(*[x for n, d in comments.items() for x in (F.lit(n), F.lit(d).cast("string"))])
        parts.append(column_profile(spark.table(ref.sql), t["name"]).select(
            F.lit(namespace).alias("namespace"), "table_name", F.lit(t["type"]).alias("table_type"),
            F.lit(owner).cast("string").alias("owner"),
            "column_index", "column_name", "column_type",
            F.element_at(about, F.col("column_name")).alias("comment"), "row_count", "non_null"))
    if not parts:
        return spark.createDataFrame(
            [], "namespace string, table_name string, table_type string, owner string, column_index int,"
                " column_name string, column_type string, comment string, row_count bigint, non_null bigint")
    return reduce(DataFrame.unionByName, parts)


def persist_docs(
    spark: SparkSession, ref: TableRef | str, description: str | None = None,
    columns: Mapping[str, str] | None = None,
) -> None:
    """Write table and column comments to the catalog; a column the table lacks is an error."""
    ref = TableRef.parse(ref)
    known = spark.table(ref.sql).columns
    names = resolve_columns(list(columns or {}), known, "persist_docs")
    if description is not None:
        spark.sql(f"COMMENT ON TABLE {ref.sql} IS {sql_text(description)}")
    for name, text in zip(names, (columns or {}).values()):
        spark.sql(f"ALTER TABLE {ref.sql} CHANGE COLUMN {quote(name)} COMMENT {sql_text(text)}")


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(namespace)}{where}")


def drop_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quote(namespace)} CASCADE")


def rename(spark: SparkSession, old: TableRef | str, new: TableRef | str) -> None:
    old, new = TableRef.parse(old), TableRef.parse(new)
    kind = tables.table_kind(spark, old)
    if kind is None:
        raise ValueError(f"{old.sql} does not exist")
    spark.sql(f"ALTER {kind.upper()} {old.sql} RENAME TO {new.sql}")
    if kind == "table":
        tables.moved_name(spark, old, new)
