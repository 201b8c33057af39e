"""Profiles of stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tablewright import tables
from tablewright.naming import TableRef
from tablewright.operators import profile
from tablewright.plans.registry import query, table
from tablewright.plans.stored import declare
from tablewright.workspace import scratch_namespace

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

_CUSTOMER = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
             ("c_mktsegment", "string")]
_ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
           ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
_DOCUMENTS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
              ("n_chars", "bigint")]


def _columns_sql(name: str, columns: list[tuple[str, str]], extra: str = "") -> str:
    return " union all ".join(
        f"select {extra} '{name}' as table_name, {i} as column_index, '{c}' as column_name, '{t}' as column_type, "
        f"count(*) as row_count, count({c}) as non_null from {name}" for i, (c, t) in enumerate(columns, 1))


@query("profile_columns", _columns_sql("documents", _DOCUMENTS))
def columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(table(spark, sf, "documents"), "documents")


@query("profile_rows", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES))
def rows(spark: SparkSession, sf: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile.row_count(table(spark, sf, t), t) for t in TABLES])


@query("profile_catalog", " union all ".join([
    _columns_sql("customer", _CUSTOMER, "'table' as table_type,"),
    _columns_sql("orders", _ORDERS, "'table' as table_type,"),
    "select 'view' as table_type, 'rich_customers' as table_name, 1 as column_index, 'c_custkey' as column_name, "
    "'bigint' as column_type, count(*) as row_count, count(*) as non_null from customer where c_acctbal > 5000",
]))
def catalog(spark: SparkSession, sf: str) -> DataFrame:
    ns = scratch_namespace(spark, "catalog")
    for name in ("customer", "orders"):
        declare(spark, sf, ns, name)
    tables.materialize_view(
        spark, f"SELECT c_custkey FROM {TableRef('customer', ns).sql} WHERE c_acctbal > 5000",
        TableRef("rich_customers", ns))
    return profile.catalog(spark, ns).drop("namespace", "owner", "comment")
