"""Scalar functions, each applied to every row of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import functions as fn
from tablewright.functions.dates import ADD_PARTS
from tablewright.plans.registry import query, table


def _apply(name: str, source: str, key: str, result: Callable[[], Column], sql: str) -> None:
    """Register ``result`` as a column beside the key of a table; ``sql`` is the same expression."""
    @query(f"fn_{name}", f"select {key}, {sql} as result from {source}")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return table(spark, sf, source).select(key, result().alias("result"))


c = F.col
_apply("array_construct", "orders", "o_orderkey",
       lambda: fn.array_construct(c("o_orderstatus"), c("o_orderpriority")), "[o_orderstatus, o_orderpriority]")
_apply("array_append", "orders", "o_orderkey",
       lambda: fn.array_append(fn.array_construct(c("o_orderstatus"), c("o_orderpriority")), c("o_orderstatus")),
       "list_append([o_orderstatus, o_orderpriority], o_orderstatus)")
_apply("array_concat", "orders", "o_orderkey",
       lambda: fn.array_concat(fn.array_construct(c("o_custkey"), c("o_orderkey")), fn.array_construct(c("o_custkey"))),
       "list_concat([o_custkey, o_orderkey], [o_custkey])")
_apply("concat", "part", "p_partkey",
       lambda: fn.concat(c("p_name"), " / ", F.nullif(c("p_type"), F.lit("ECONOMY"))),
       "p_name || ' / ' || nullif(p_type, 'ECONOMY')")
_apply("date", "orders", "o_orderkey",
       lambda: fn.date_from_parts(F.year("o_orderdate"), F.month("o_orderdate"), 1),
       "make_date(year(o_orderdate), month(o_orderdate), 1)")
_apply("cast", "lineitem", "l_orderkey", lambda: fn.cast(c("l_linenumber"), "string"), "cast(l_linenumber as varchar)")
_apply("safe_cast", "orders", "o_orderkey",
       lambda: fn.safe_cast(F.replace(c("o_orderpriority"), F.lit("-"), F.lit("")), "bigint"),
       "try_cast(replace(o_orderpriority, '-', '') as bigint)")
_apply("bool_to_text", "labels", "doc_id", lambda: fn.bool_to_text(c("quality") == 1), "cast(quality = 1 as varchar)")
_apply("hash", "orders", "o_orderkey", lambda: fn.hash_text(c("o_orderkey")), "md5(cast(o_orderkey as varchar))")
_apply("length", "documents", "doc_id", lambda: fn.length(c("text")).cast("bigint"), "cast(length(text) as bigint)")
_apply("position", "documents", "doc_id", lambda: fn.position("the", c("text")).cast("bigint"),
       "cast(position('the' in text) as bigint)")
_apply("replace", "documents", "doc_id", lambda: fn.replace(c("text"), "the", "THE"), "replace(text, 'the', 'THE')")
_apply("right", "documents", "doc_id", lambda: fn.right(c("text"), 12), "right(text, 12)")
_apply("literal_quote", "customer", "c_custkey",
       lambda: fn.concat(c("c_name"), fn.string_literal("'s \"own\" \\ account")),
       "c_name || '''s \"own\" \\ account'")
_apply("assert_not_null", "customer", "c_custkey",
       lambda: fn.assert_not_null(F.nullif(c("c_mktsegment"), F.lit("BUILDING"))), "nullif(c_mktsegment, 'BUILDING')")
_apply("assert_not_null_strict", "customer", "c_custkey",
       lambda: fn.assert_not_null(c("c_mktsegment"), strict=True), "c_mktsegment")


@query("fn_split_part", """
select o_orderkey, split_part(o_orderpriority, '-', 1) as first_part,
       nullif(split_part(o_orderpriority, '-', 2), '') as second_part,
       split_part(o_orderpriority, '-', -1) as last_part
from orders
""")
def split_part(spark: SparkSession, sf: str) -> DataFrame:
    text = c("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.split_part(text, "-", 0).alias("first_part"),
        fn.split_part(text, "-", 2).alias("second_part"), fn.split_part(text, "-", -1).alias("last_part"))


@query("fn_split_part_by_column", """
select o_orderkey, split_part(o_orderpriority || o_orderstatus || 'x', o_orderstatus, 1) as before_status,
       nullif(split_part(o_clerk, '#', 1), '') as clerk
from (select *, 'Clerk#' || o_custkey as o_clerk from orders)
""")
def split_part_by_column(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat("o_orderpriority", "o_orderstatus", F.lit("x"))
    clerk = F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string"))
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.split_part(text, c("o_orderstatus"), 1).alias("before_status"),
        fn.split_part(clerk, F.lit("#"), 1).alias("clerk"))


@query("fn_date_trunc", "select event_id, " + ", ".join(
    f"cast(date_trunc('{p}', ts) as timestamp) as {p}_start"
    for p in ("hour", "day", "week", "month", "quarter", "year")) + " from events")
def date_trunc(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", *[
        fn.date_trunc(p, c("ts")).alias(f"{p}_start") for p in ("hour", "day", "week", "month", "quarter", "year")])


@query("fn_last_day", """
select o_orderkey, last_day(o_orderdate) as month_end,
       cast(date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day as date) as quarter_end,
       make_date(year(o_orderdate), 12, 31) as year_end
from orders
""")
def last_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", *[
        fn.last_day(c("o_orderdate"), p).alias(f"{p}_end") for p in ("month", "quarter", "year")])


_STEP = {p: f"interval (hour(ts) - 12) {p}" for p in ADD_PARTS}
_STEP["quarter"] = "interval (3 * (hour(ts) - 12)) month"
_STEP["week"] = "interval (7 * (hour(ts) - 12)) day"

for _part in ADD_PARTS:
    # The number of parts depends on the row and may be negative.
    _apply(f"dateadd_{_part}", "events", "event_id",
           lambda part=_part: fn.dateadd(part, (F.hour("ts") - 12).cast("int"), c("ts")), f"ts + {_STEP[_part]}")

_MIDDLE = "2024-01-15 12:34:56"
_E = f"timestamp '{_MIDDLE}'"
_SECONDS = f"(epoch_us({_E}) // 1000000 - epoch_us(ts) // 1000000)"


def _begun(unit: int) -> str:
    return (f"cast(case when {_SECONDS} > 0 then ceil({_SECONDS} / {unit}.0) "
            f"else floor({_SECONDS} / {unit}.0) end as bigint)")


_DIFF = {
    "day": f"date_diff('day', cast(ts as date), cast({_E} as date))",
    "week": f"cast(floor((epoch({_E}) // 86400 + 4) / 7) - floor((epoch(ts) // 86400 + 4) / 7) as bigint)",
    "month": f"cast((year({_E}) - year(ts)) * 12 + month({_E}) - month(ts) as bigint)",
    "quarter": f"cast((year({_E}) - year(ts)) * 4 + quarter({_E}) - quarter(ts) as bigint)",
    "year": f"cast(year({_E}) - year(ts) as bigint)",
    "hour": _begun(3600),
    "minute": _begun(60),
    "second": f"cast({_SECONDS} as bigint)",
    "millisecond": f"epoch_us({_E}) // 1000 - epoch_us(ts) // 1000",
    "microsecond": f"epoch_us({_E}) - epoch_us(ts)",
}

for _part in ADD_PARTS:
    # Half of the events lie before the fixed moment, half behind it.
    _apply(f"datediff_{_part}", "events", "event_id",
           lambda part=_part: fn.datediff(c("ts"), F.lit(_MIDDLE).cast("timestamp_ntz"), part), _DIFF[_part])


@query("fn_datediff_calendar", """
select l_orderkey, l_linenumber, l_shipdate,
       cast(date_diff('day', cast(l_shipdate as date), cast(o_orderdate as date)) as bigint) as days,
       cast((year(o_orderdate) - year(l_shipdate)) * 12 + month(o_orderdate) - month(l_shipdate) as bigint) as months,
       cast((year(o_orderdate) - year(l_shipdate)) * 4 + quarter(o_orderdate) - quarter(l_shipdate) as bigint)
           as quarters,
       cast(year(o_orderdate) - year(l_shipdate) as bigint) as years
from lineitem join orders on o_orderkey = l_orderkey
""")
def datediff_calendar(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), c("o_orderkey") == c("l_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_shipdate", *[
        fn.datediff(c("l_shipdate"), c("o_orderdate"), p).alias(f"{p}s") for p in ("day", "month", "quarter", "year")])
