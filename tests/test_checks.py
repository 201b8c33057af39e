from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from tablewright import TableRef
from tablewright.operators import checks
from tablewright.operators.constraints import Check, checks_from, contract, enforce, not_null_check


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_generic_checks(spark):
    df = ids(spark, 1, 1, 2, None, None)
    assert checks.not_null(df, "id").count() == 2
    assert rows(checks.unique(df, "id")) == [(1, 2)]
    assert rows(checks.accepted_values(df, "id", [2, 3])) == [(1, 2)]
    assert rows(checks.relationships(df, "id", ids(spark, 2, 2, 5), "id")) == [(1,), (1,)]


def test_evaluate(spark):
    failing = ids(spark, 1, 2, 3)
    one = lambda *a, **k: tuple(checks.evaluate(*a, **k).first())
    assert one(failing) == (3, True, True)
    assert one(failing.limit(0)) == (0, False, False)
    assert one(failing, warn_if=">2", error_if="> 10") == (3, True, False)
    assert one(failing, limit=2) == (2, True, True)
    assert one(failing, fail_calc="sum(id)", error_if="> 5") == (6, True, True)
    assert one(failing, severity="warn") == (3, True, False)
    with pytest.raises(ValueError):
        checks.evaluate(failing, severity="fatal")


def test_stored_failures_replace_the_last_ones(spark, ns):
    """Eight tests over a small project: four pass, four fail with 2, 2, 2 and 10 rows."""
    people = spark.createDataFrame(
        [(i, f"p{i}") for i in range(1, 11)], "id bigint, name string")
    problematic = people.withColumn("id", F.when(F.col("id") <= 2, None).when(F.col("id") <= 4, 99)
                                    .when(F.col("id") <= 6, 98).otherwise(F.col("id")))
    failing = {
        "passing": people.filter("1 = 2"), "failing": people,
        "fine_unique": checks.unique(people, "id"), "fine_not_null": checks.not_null(people, "id"),
        "fine_accepted": checks.accepted_values(people.filter("id = 1"), "name", ["p1"]),
        "bad_unique": checks.unique(problematic, "id"), "bad_not_null": checks.not_null(problematic, "id"),
        "bad_accepted": checks.accepted_values(problematic, "name", [f"p{i}" for i in range(1, 9)]),
    }
    audit = TableRef("audit", ns)
    counts = [checks.store_failures(df, audit.sibling(f"audit_{n}")).count() for n, df in failing.items()]
    assert sorted(counts) == [0, 0, 0, 0, 2, 2, 2, 10]
    assert checks.store_failures(people.limit(1), audit.sibling("audit_failing")).count() == 1


def test_is_type(spark):
    df = spark.sql("select 1 as a, 1L as b, 'x' as c, 1.5BD as d, 1.5D as e, true as f, "
                   "current_date() as g, current_timestamp() as h")
    assert checks.is_type(df, {
        "a": ["integer", "number", "not string"], "B": ["integer"], "c": ["string", "not number"],
        "d": ["numeric", "number", "not float"], "e": ["float"], "f": ["boolean", "not number"],
        "g": ["date", "not timestamp"], "h": ["timestamp"]}) == []
    assert checks.is_type(df, {"a": ["string"], "c": ["not string"]}) == [
        "a is int, expected string", "c is string, expected not string"]
    with pytest.raises(ValueError, match="colour"):
        checks.is_type(df, {"a": ["colour"]})
    with pytest.raises(ValueError, match="no such column zz"):
        checks.is_type(df, {"zz": ["string"]})


def test_relations_equal_is_a_set_comparison(spark):
    a, b = ids(spark, 1, 1, 2, None), ids(spark, 1, 2, 3, None)
    assert tuple(checks.relations_equal(a, b).first()) == (0, 1)
    assert tuple(checks.relations_equal(a, ids(spark, 1, 2, None)).first()) == (1, 0)
    assert tuple(checks.relations_equal(a.limit(0), b.limit(0)).first()) == (0, 0)
    wide = b.withColumn("x", F.lit(1))
    assert tuple(checks.relations_equal(a, wide, ["id"]).first()) == (0, 1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4) | st.none(), max_size=8), st.lists(st.integers(0, 4) | st.none(), max_size=8))
def test_relations_equal_against_sets(spark, left, right):
    got = tuple(checks.relations_equal(ids(spark, *left), ids(spark, *right)).first())
    assert got == (len(left) - len(right), len(set(left) ^ set(right)))


NESTED = """int int, double double, string string, yes boolean, day date, at timestamp_ntz, list array<int>,
    map map<string, int>, pair struct<a: int, b: map<string, int>>"""


def test_unit_test_on_every_type(spark):
    row = (1, 2.0, "12345", True, date(2020, 1, 2), datetime(2020, 1, 2, 3), [1, 2, 3],
           {"b": None, "a": 1}, (1, {"z": 2, "y": 3}))
    given_rows = spark.createDataFrame([row], NESTED)
    upper = given_rows.toDF(*[c.upper() for c in given_rows.columns])
    same = lambda source: source.select("*")
    assert checks.unit_test(same, {"source": given_rows}, upper).isEmpty()
    changed = spark.createDataFrame([row[:7] + ({"b": 2, "a": 1},) + row[8:]], NESTED)
    diff = checks.unit_test(same, {"source": given_rows}, changed)
    assert rows(diff, "only_in", "copies") == [("actual", 1), ("expected", 1)]
    assert rows(checks.rows_differ(ids(spark, 1, 1), ids(spark, 1))) == [("actual", 1, 1)]
    with pytest.raises(ValueError, match="no such column other"):
        checks.rows_differ(ids(spark, 1), spark.sql("select 1 as other"))


def test_contract(spark):
    model = spark.sql("select 'blue' as color, 1 as id, '2019-01-01' as date_day")
    agreed = contract(model, "id int, color string, date_day string")
    assert agreed.columns == ["id", "color", "date_day"]
    for wrong, message in (("id bigint, color string, date_day string", "id is int"),
                           ("id int, color string", "unexpected date_day"),
                           ("id int, color string, date_day string, x int", "missing x"),
                           ("id decimal(4,2), color array<string>, date_day string", "color is string")):
        with pytest.raises(ValueError, match=message):
            contract(model, wrong)


def test_constraints(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, n int")
    dropped = Observation("dropped")
    kept = enforce(df, [Check("n > 0", "positive", "DROP"), Check("id < 3"), not_null_check("id")], dropped)
    assert rows(kept) == [(1, 5)]
    assert dropped.get == {"positive": 2}
    with pytest.raises(Exception, match="constraint positive violated"):
        enforce(df, [Check("n > 0", "positive")]).count()
    with pytest.raises(Exception, match="n_not_null"):
        enforce(df, [not_null_check("n")]).count()
    with pytest.raises(ValueError):
        Check("n > 0", on_mismatch="IGNORE")
    (check,) = checks_from([{"expression": "id > 0"}])
    assert check.on_mismatch == "FAIL" and len(check.label) == 32


def test_a_constraint_judges_only_rows_that_reach_it(spark):
    """Catalyst must not move the condition below the join or the filter."""
    bad = spark.createDataFrame([(1, 5), (2, -1)], "id int, n int")
    wanted = spark.createDataFrame([(1,)], "id int")
    assert enforce(bad.join(wanted, "id"), [Check("n > 0")]).count() == 1
    assert enforce(bad.filter("id = 1"), [Check("n > 0")]).count() == 1
    grouped = bad.groupBy("id").agg(F.sum("n").alias("n")).join(wanted, "id")
    assert enforce(grouped, [Check("id = 1")]).count() == 1


def test_decimal_keys_compare_by_value(spark):
    a = spark.createDataFrame([(Decimal("1.10"),)], "d decimal(10,2)")
    assert tuple(checks.relations_equal(a, a.select(F.col("d"))).first()) == (0, 0)
