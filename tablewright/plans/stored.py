"""Writing tables, views, seeds and clones, each read back from the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.naming import TableRef
from tablewright.operators.checks import is_type
from tablewright.plans.registry import cents, query, table
from tablewright.plans.relational import customers, stg_orders
from tablewright.sources.files import source
from tablewright.sources.seeds import seed
from tablewright.tables import Storage
from tablewright.workspace import scratch_namespace, scratch_path


def declare(spark: SparkSession, sf: str, namespace: str, name: str) -> TableRef:
    """An external table on a source file, nothing copied."""
    ref = TableRef(name, namespace)
    spark.catalog.createTable(ref.sql, path=f"{sf}/{name}.parquet", source="parquet")
    return ref


@query("source_scan", "select l_orderkey, l_partkey, l_quantity, l_shipdate from lineitem")
def source_scan(spark: SparkSession, sf: str) -> DataFrame:
    ns = scratch_namespace(spark, "source")
    declare(spark, sf, ns, "lineitem")
    return source(spark, ns, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


def _customer_file(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "customer-csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return path


@query("seed_csv", """
select c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_acctbal, c_mktsegment from customer
""")
def seed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Types are inferred, except that the nation is declared as text."""
    ref = TableRef("customer", scratch_namespace(spark, "seed"))
    return seed(spark, _customer_file(spark, sf), ref, {"c_nationkey": "string"})


@query("test_is_type", """
select 'c_custkey' as column_name, 'integer' as column_check, count(c_custkey) as n_values from customer
union all select 'c_name', 'string', count(c_name) from customer
union all select 'c_nationkey', 'not string', count(c_nationkey) from customer
union all select 'c_acctbal', 'number', count(c_acctbal) from customer
union all select 'c_mktsegment', 'not number', count(c_mktsegment) from customer
""")
def typed_seed(spark: SparkSession, sf: str) -> DataFrame:
    """A seed's inferred types pass their checks; reported with the values of each checked column."""
    checks = {"c_custkey": ["integer"], "c_name": ["string"], "c_nationkey": ["not string"],
              "c_acctbal": ["number"], "c_mktsegment": ["not number"]}
    loaded = seed(spark, _customer_file(spark, sf), TableRef("customer", scratch_namespace(spark, "types")))
    problems = is_type(loaded, checks)
    if problems:
        raise AssertionError("; ".join(problems))
    counted = loaded.agg(*[F.count(c).alias(c) for c in checks])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("column_check"), F.col(c).alias("n_values"))
                     for c, ks in checks.items() for k in ks])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


@query("table_ctas", """
with per_order as (
    select l_orderkey, sum(cast(round(l_extendedprice * 100) as bigint)) as amount_cents
    from lineitem group by l_orderkey
), customer_orders as (
    select o_custkey, min(o_orderdate) as first_order, max(o_orderdate) as most_recent_order,
           count(*) as number_of_orders, sum(amount_cents) as total_cents
    from orders left join per_order on l_orderkey = o_orderkey group by o_custkey
)
select c_custkey as customer_id, c_name as customer_name, first_order, most_recent_order, number_of_orders,
       cast(total_cents as bigint) / 100.0::double as customer_lifetime_value
from customer left join customer_orders on o_custkey = c_custkey
""")
def ctas(spark: SparkSession, sf: str) -> DataFrame:
    """The customers model as a table, built twice: the second build replaces the first."""
    ref = TableRef("customers", scratch_namespace(spark, "ctas"))
    tables.materialize_table(stg_orders(spark, sf), ref)
    return tables.materialize_table(lambda: customers(spark, sf), ref, Storage(comment="one row per customer"))


@query("table_partitioned", """
select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus from orders
""")
def partitioned(spark: SparkSession, sf: str) -> DataFrame:
    ref = TableRef("orders", scratch_namespace(spark, "part"))
    return tables.write_table(table(spark, sf, "orders"), ref, Storage(partition_by="o_orderstatus"))


@query("table_bucketed", """
select o_orderkey, o_orderstatus, count(*) as n_lines, sum(cast(round(l_extendedprice * 100) as bigint))::bigint as cents
from orders join lineitem on o_orderkey = l_orderkey group by all
""")
def bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables bucketed on the join key: neither is shuffled to be joined by it.

    Lines are added up per order before they are stored, so no bucket holds more than its share.
    """
    ns = scratch_namespace(spark, "bucket")
    orders = tables.write_table(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), TableRef("orders", ns),
                                Storage(clustered_by="o_orderkey", buckets=8))
    per_order = tables.write_table(
        table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum(cents("l_extendedprice")).alias("cents")),
        TableRef("order_totals", ns), Storage(clustered_by="l_orderkey", buckets=8))
    return orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


@query("view_model", """
select o_orderkey, o_custkey, o_orderdate, o_orderstatus = 'F' as is_finished from orders
""")
def view_model(spark: SparkSession, sf: str) -> DataFrame:
    ns = scratch_namespace(spark, "view")
    orders = declare(spark, sf, ns, "orders")
    return tables.materialize_view(
        spark, f"SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus = 'F' AS is_finished FROM {orders.sql}",
        TableRef("order_state", ns), comment="orders and whether they are done",
        column_comments={"is_finished": "nothing left to ship"})


@query("ephemeral_model", """
with per_customer as (select o_custkey, count(*) as n_orders from orders group by o_custkey)
select c_mktsegment, sum(n_orders)::bigint as n_orders
from customer join per_customer on o_custkey = c_custkey group by all
""")
def ephemeral(spark: SparkSession, sf: str) -> DataFrame:
    """A model that is only ever part of another one's plan."""
    def orders_per_customer() -> DataFrame:
        return stg_orders(spark, sf).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))

    joined = table(spark, sf, "customer").join(orders_per_customer(), F.col("customer_id") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("n_orders").alias("n_orders"))


@query("swap_view_to_table", "select o_orderkey, o_custkey, o_orderstatus from orders")
def swap_type(spark: SparkSession, sf: str) -> DataFrame:
    """One name as a table, then a view, then a table again."""
    ns = scratch_namespace(spark, "swap")
    orders = declare(spark, sf, ns, "orders")
    ref = TableRef("model", ns)
    wanted = spark.table(orders.sql).select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.materialize_table(wanted.drop("o_custkey"), ref)
    tables.materialize_view(spark, f"SELECT o_orderkey FROM {orders.sql}", ref)
    return tables.materialize_table(wanted, ref)


@query("clone_table", """
select 'clone' as which, count(*) as n, sum(o_orderkey)::bigint as keys from orders
union all select 'source', 2 * count(*), (2 * sum(o_orderkey))::bigint from orders
""")
def clone(spark: SparkSession, sf: str) -> DataFrame:
    """A clone keeps its rows when the source gets more."""
    ns = scratch_namespace(spark, "clone")
    src, dst = TableRef("orders", ns), TableRef("orders_clone", ns)
    tables.write_table(table(spark, sf, "orders"), src)
    tables.clone(spark, src, dst)
    tables.append_rows(table(spark, sf, "orders"), src)

    def measure(ref: TableRef, label: str) -> DataFrame:
        return spark.table(ref.sql).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).select(
            F.lit(label).alias("which"), "n", "keys")

    return measure(dst, "clone").unionByName(measure(src, "source"))


@query("clone_by_partition", """
select 'clone' as which, * replace (case when o_orderstatus = 'P' then -o_orderkey else o_orderkey end as o_orderkey)
from orders
union all select 'clone', * replace (o_orderkey + 1000000000 as o_orderkey) from orders where o_orderstatus = 'F'
union all select 'source', * from orders
""")
def clone_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """A clone appends to one partition and replaces another; only these two are copied, the source sees neither."""
    ns = scratch_namespace(spark, "parts")
    src, dst = TableRef("orders", ns), TableRef("orders_clone", ns)
    orders = table(spark, sf, "orders")
    tables.write_table(orders, src, Storage(partition_by="o_orderstatus"))
    tables.clone(spark, src, dst)
    tables.append_rows(orders.filter("o_orderstatus = 'F'").withColumn(
        "o_orderkey", F.col("o_orderkey") + F.lit(1_000_000_000).cast(orders.schema["o_orderkey"].dataType)), dst)
    tables.overwrite_partitions(
        spark.table(dst.sql).filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey")), dst)
    label = lambda ref, which: spark.table(ref.sql).select(F.lit(which).alias("which"), "*")
    return label(dst, "clone").unionByName(label(src, "source"))


@query("show_limit", "select * from orders order by o_totalprice desc, o_orderkey limit 25")
def show_limit(spark: SparkSession, sf: str) -> DataFrame:
    ranked = table(spark, sf, "orders").withColumn("__down", -F.col("o_totalprice"))
    return tables.show(ranked, 25, ["__down", "o_orderkey"]).drop("__down")


@query("rel_update_where", """
select * replace (
    case when o_orderstatus = 'O' and o_orderdate < timestamp '1998-01-01' then 'F' else o_orderstatus end
    as o_orderstatus) from orders
""")
def update_where(spark: SparkSession, sf: str) -> DataFrame:
    ref = TableRef("orders", scratch_namespace(spark, "update"))
    tables.write_table(table(spark, sf, "orders"), ref)
    old = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return tables.update_where(spark, ref, old, {"o_orderstatus": F.lit("F")})
