"""Small reference tables kept as CSV files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import tables
from tablewright.naming import TableRef, quote, resolve_columns
from tablewright.tables import Storage

_WIDENED = {T.IntegerType(): "bigint", T.ShortType(): "bigint", T.ByteType(): "bigint"}


def read_seed(
    spark: SparkSession,
    path: str,
    column_types: Mapping[str, str] | None = None,
    delimiter: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """The rows of a CSV file with a header, read by the executors.

    Types are inferred (whole numbers as bigint) except where ``column_types`` names one; such a
    column is read as text first, so that nothing is lost before its cast.  A missing value is NULL,
    a doubled quote inside quotes is a quote.  ``multi_line`` allows line breaks inside quotes, at
    the price that a file is read by one task.
    """
    options = {"header": "true", "sep": delimiter, "quote": '"', "escape": '"', "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    declared = column_types or {}
    types = dict(zip(resolve_columns(list(declared), names, "column_types"), declared.values()))
    inferred: dict[str, T.DataType] = {}
    if len(types) < len(names):
        inferred = {f.name: f.dataType for f in spark.read.options(**options, inferSchema="true").csv(path).schema}
    schema = T.StructType([T.StructField(c, T.StringType() if c in types else inferred[c]) for c in names])
    rows = spark.read.options(**options).schema(schema).csv(path)
    return rows.select(*[
        F.col(quote(c)).cast(types.get(c) or _WIDENED.get(schema[c].dataType) or schema[c].dataType).alias(c)
        for c in names])


def seed(
    spark: SparkSession,
    path: str,
    ref: TableRef | str,
    column_types: Mapping[str, str] | None = None,
    delimiter: str = ",",
    multi_line: bool = False,
    storage: Storage = Storage(),
    full_refresh: bool = True,
) -> DataFrame:
    """Load a CSV file as a table, replacing a table or view of that name.

    Without ``full_refresh`` an existing table keeps its columns and types and gets the file's rows.
    """
    ref = TableRef.parse(ref)
    if not full_refresh and tables.table_kind(spark, ref) == "table":
        target = tables.fresh(spark, ref)
        kinds = {f.name: f.dataType.simpleString() for f in target.schema}
        return tables.rewrite(tables.by_target(read_seed(spark, path, kinds, delimiter, multi_line), target), ref)
    return tables.write_table(read_seed(spark, path, column_types, delimiter, multi_line), ref, storage)
