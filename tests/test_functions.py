import math
import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright import functions as fn
from tablewright.functions.dates import ADD_PARTS

c = F.col


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def test_last_day(spark):
    day = F.lit("2018-01-02").cast("date")
    got = [str(value(spark, fn.last_day(day, p))) for p in ("month", "quarter", "year")]
    assert got == ["2018-01-31", "2018-03-31", "2018-12-31"]
    with pytest.raises(ValueError):
        fn.last_day(day, "week")


@pytest.mark.parametrize("text, delimiter", [("a|b|c", "|"), ("1|2|3", "|"), ("a.b.c", "."), ("x__y__z", "__"),
                                             ("p(*q(*r", "(*")])
def test_split_part(spark, text, delimiter):
    parts = text.split(delimiter)
    got = [value(spark, fn.split_part(F.lit(text), delimiter, n)) for n in (0, 1, 2, 3, -1, -3, 4, -4)]
    assert got == [parts[0], parts[0], parts[1], parts[2], parts[2], parts[0], None, None]


def test_text_and_types(spark):
    null = F.lit(None).cast("string")
    assert value(spark, fn.concat("a", F.lit("b"))) == "ab"
    assert value(spark, fn.concat("a", null)) is None
    assert [value(spark, fn.position(p, F.lit("land"))) for p in ("l", "nd", "z")] == [1, 3, 0]
    assert value(spark, fn.replace(F.lit("a,b,c"), ",", "")) == "abc"
    assert [value(spark, fn.right(F.lit("12345"), n)) for n in (3, 0, 9)] == ["345", "", "12345"]
    assert value(spark, fn.length(F.lit("héé"))) == 3
    assert value(spark, fn.hash_text(F.lit("ab"))) == "187ef4436122d1cc2f40dc2b92f0eba0"
    assert value(spark, fn.bool_to_text(F.lit(True))) == "true"
    tried = ("12", " 7 ", "x", "1e3", "-", "3.9", "", True, 2.5e9, null)
    assert [value(spark, fn.safe_cast(x, "int")) for x in tried] == [
        value(spark, (x if x is null else F.lit(x)).try_cast("int")) for x in tried]
    assert [value(spark, fn.safe_cast(x, "int")) for x in ("12", "x", True, null)] == [12, None, 1, None]
    assert value(spark, fn.safe_cast(F.array(F.lit(1), F.lit(2)), "array<string>")) == ["1", "2"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, fn.cast("x", "int"))
    assert value(spark, fn.string_literal("they're \\ \"here\"")) == "they're \\ \"here\""
    assert value(spark, fn.literal("2020-01-02", "date")) == date(2020, 1, 2)
    assert value(spark, fn.array_append(fn.array_construct(1, 2), 3)) == [1, 2, 3]
    assert value(spark, fn.array_concat(fn.array_construct(1, 2), fn.array_construct(2))) == [1, 2, 2]
    assert value(spark, fn.assert_not_null(null)) is None
    with pytest.raises(Exception, match="found a NULL"):
        value(spark, fn.assert_not_null(null, strict=True))
    assert value(spark, fn.date_from_parts(2020, 2, 29)) == date(2020, 2, 29)


def test_current_timestamp_is_now(spark):
    now = value(spark, F.unix_seconds(fn.current_timestamp()))
    assert abs(now - datetime.now().timestamp()) < 600


def test_dateadd(spark):
    start = "2020-01-31 10:20:30.123456"
    expected = {
        "day": "2020-02-01 10:20:30.123456", "week": "2020-02-07 10:20:30.123456",
        "month": "2020-02-29 10:20:30.123456", "quarter": "2020-04-30 10:20:30.123456",
        "year": "2021-01-31 10:20:30.123456", "hour": "2020-01-31 11:20:30.123456",
        "minute": "2020-01-31 10:21:30.123456", "second": "2020-01-31 10:20:31.123456",
        "millisecond": "2020-01-31 10:20:30.124456", "microsecond": "2020-01-31 10:20:30.123457",
    }
    assert {p: str(value(spark, fn.dateadd(p, 1, stamp(start)))) for p in ADD_PARTS} == expected
    assert str(value(spark, fn.dateadd("month", -2, F.lit("2020-04-30").cast("date")))) == "2020-02-29 00:00:00"
    with pytest.raises(ValueError):
        fn.dateadd("decade", 1, stamp(start))


def expected_diff(a, b, part):
    """Written down from the rules, not from the implementation."""
    days = lambda t: t.date().toordinal()
    if part == "day":
        return days(b) - days(a)
    if part == "week":  # Sundays crossed, one by one
        step = 1 if b > a else -1
        lo, hi = sorted((a.date(), b.date()))
        return step * sum((lo + timedelta(n)).weekday() == 6 for n in range(1, (hi - lo).days + 1))
    if part == "month":
        return (b.year - a.year) * 12 + b.month - a.month
    if part == "quarter":
        return (b.year - a.year) * 4 + (b.month - 1) // 3 - (a.month - 1) // 3
    if part == "year":
        return b.year - a.year
    whole = lambda t: (t.replace(microsecond=0) - datetime(1970, 1, 1)) // timedelta(seconds=1)
    if part in ("hour", "minute", "second"):
        parts = (whole(b) - whole(a)) / {"hour": 3600, "minute": 60, "second": 1}[part]
        return math.ceil(parts) if parts > 0 else math.floor(parts)
    micros = lambda t: (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    if part == "millisecond":
        return micros(b) // 1000 - micros(a) // 1000
    return micros(b) - micros(a)


def test_datediff_against_the_rules(spark):
    rng = random.Random(7)
    moments = [datetime(2019, 12, 28) + timedelta(microseconds=rng.randrange(800 * 86400 * 10**6)) for _ in range(150)]
    moments += [datetime(2021, 1, 31), datetime(2021, 2, 28), datetime(2020, 2, 29), datetime(1969, 12, 28, 23, 59, 59)]
    pairs = [(rng.choice(moments), rng.choice(moments)) for _ in range(500)]
    pairs += [(datetime(2020, 1, 1, 10, 10), datetime(2020, 1, 1, 10, 40)), (moments[0], moments[0])]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", *[fn.datediff(c("a"), c("b"), p).alias(p) for p in ADD_PARTS]).collect()
    for row in got:
        assert {p: row[p] for p in ADD_PARTS} == {p: expected_diff(row.a, row.b, p) for p in ADD_PARTS}
    with pytest.raises(ValueError):
        fn.datediff(c("a"), c("b"), "decade")


def test_aggregates(spark):
    df = spark.createDataFrame([(1, True, "x"), (1, False, "x"), (2, False, "y"), (2, None, "y")],
                               "g int, f boolean, v string")
    got = df.groupBy("g").agg(fn.bool_or(c("f")).alias("b"), fn.any_value(c("v")).alias("a"))
    assert rows(got, "g", "b", "a") == [(1, True, "x"), (2, False, "y")]


LIST = [(3, "g", 1), (3, "g", 2), (3, "p", 3), (1, "b", 2), (1, "a", 1), (2, None, 1), (2, "z", 2), (4, None, 1)]


def test_listagg(spark):
    df = spark.createDataFrame(LIST, "grp int, txt string, o int")
    as_column = df.groupBy("grp").agg(fn.listagg(c("txt"), "|", [c("o")]).alias("l"))
    assert rows(as_column, "grp", "l") == [(1, "a|b"), (2, "z"), (3, "g|g|p"), (4, "")]
    limited = df.groupBy("grp").agg(fn.listagg(c("txt"), "_|_", [c("o").desc()] and [-c("o")], limit=2).alias("l"))
    assert dict(rows(limited))[3] == "p_|_g"
    frame = fn.listagg_rows(df, "grp", "txt", "l", "|", order_by="o")
    assert rows(frame, "grp", "l") == [(1, "a|b"), (2, "z"), (3, "g|g|p"), (4, "")]
    assert rows(fn.listagg_rows(df, ["grp"], "txt", "l", distinct=True)) == [(1, "a,b"), (2, "z"), (3, "g,p"), (4, "")]
    assert rows(fn.listagg_rows(df, "grp", "txt", "l", order_by="o", limit=1)) == [(1, "a"), (2, "z"), (3, "g"), (4, "")]
    with pytest.raises(ValueError):
        fn.listagg_rows(df, "grp", "txt", "l", order_by="o", distinct=True)


def test_listagg_of_one_repeated_value(spark):
    df = spark.range(0, 5000, 1, 6).select(F.lit(1).alias("g"), F.when(F.col("id") % 5 > 0, "same").alias("v"))
    for limit, size in ((None, 4000), (1200, 1200), (3, 3)):
        assert fn.listagg_rows(df, "g", "v", "l", limit=limit).first()["l"].split(",") == ["same"] * size


def test_listagg_of_a_hot_group(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") < 2000, 0).otherwise(F.col("id") / 7).cast("int").alias("g"),
        F.md5(F.col("id").cast("string")).alias("o"), F.col("id").alias("v")).repartition(8)
    expected = defaultdict(list)
    for r in df.collect():
        expected[r.g].append((r.o, r.v))
    got = dict(rows(fn.listagg_rows(df, "g", "v", "l", ",", order_by="o"), "g", "l"))
    assert got == {g: ",".join(str(v) for _, v in sorted(vs)) for g, vs in expected.items()}
    for limit in (2, 1500):
        first = dict(rows(fn.listagg_rows(df, "g", "v", "l", ",", order_by="o", limit=limit), "g", "l"))
        assert first == {g: ",".join(str(v) for _, v in sorted(vs)[:limit]) for g, vs in expected.items()}
    assert "WindowGroupLimit" in fn.listagg_rows(df, "g", "v", "l", limit=2)._jdf.queryExecution().toString()
    # The hot group's rows were spread over several tasks before they were joined.
    plan = fn.listagg_rows(df, "g", "v", "l", ",", order_by="o")._jdf.queryExecution().toString()
    assert "rangepartitioning(g" in plan
