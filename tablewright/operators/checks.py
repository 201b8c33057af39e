"""Data tests: each returns the failing rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import tables
from tablewright.naming import TableRef, quote, resolve_columns
from tablewright.operators.comparing import comparable_frame
from tablewright.tables import Storage


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(quote(column)).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULL is not a value."""
    value = F.col(quote(column))
    return (
        df.filter(value.isNotNull()).groupBy(value.alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the list, with their count; NULL is neither in the list nor outside it."""
    counted = df.groupBy(F.col(quote(column)).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent, one row per child row; a NULL key has no parent to miss."""
    keys = child.filter(F.col(quote(column)).isNotNull()).select(F.col(quote(column)).alias("from_field"))
    known = parent.select(F.col(quote(field)).alias("from_field")).distinct()  # a hot parent key counts once
    return keys.join(known, "from_field", "left_anti")


def evaluate(
    failing: DataFrame,
    fail_calc: str = "count(*)",
    warn_if: str = "!= 0",
    error_if: str = "!= 0",
    limit: int | None = None,
    severity: str = "error",
) -> DataFrame:
    """One row: the failure count and whether it warns or errors.

    With ``severity="warn"`` nothing is an error.
    """
    if severity not in ("error", "warn"):
        raise ValueError("severity must be error or warn")
    if limit is not None:
        failing = failing.limit(limit)
    counted = failing.agg(F.expr(fail_calc).alias("calculated"))
    errors = F.expr(f"calculated {error_if}") if severity == "error" else F.lit(False)
    return counted.select(
        F.col("calculated").cast("bigint").alias("failures"),
        F.expr(f"calculated {warn_if}").alias("should_warn"),
        errors.alias("should_error"),
    )


def store_failures(failing: DataFrame, ref: TableRef | str) -> DataFrame:
    """Keep the failing rows in an audit table, replacing those of the last run."""
    return tables.write_table(failing, ref, Storage())


_TYPE_TESTS: Mapping[str, Callable[[T.DataType], bool]] = {
    "string": lambda t: isinstance(t, T.StringType),
    "number": lambda t: isinstance(t, T.NumericType),
    "numeric": lambda t: isinstance(t, T.DecimalType),
    "integer": lambda t: isinstance(t, T.IntegralType),
    "float": lambda t: isinstance(t, (T.FloatType, T.DoubleType)),
    "boolean": lambda t: isinstance(t, T.BooleanType),
    "date": lambda t: isinstance(t, T.DateType),
    "timestamp": lambda t: isinstance(t, (T.TimestampType, T.TimestampNTZType)),
}


def is_type(df: DataFrame, expected: Mapping[str, Sequence[str]]) -> list[str]:
    """What is wrong with the column types; ``expected`` lists checks such as ``number`` or ``not string``."""
    resolve_columns(list(expected), df.columns, "is_type")
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    problems = []
    for column, wanted in expected.items():
        for check in wanted:
            negated, _, name = check.rpartition("not ")
            if name not in _TYPE_TESTS:
                raise ValueError(f"is_type: unknown check {check!r}")
            kind = kinds[column.lower()]
            if _TYPE_TESTS[name](kind) == bool(negated or check.startswith("not ")):
                problems.append(f"{column} is {kind.simpleString()}, expected {check}")
    return problems


def relations_equal(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: difference of the row counts, and how many distinct rows only one side has.

    A single pass: rows of both sides are counted per content before the shuffle, so copies cost nothing.
    """
    names = resolve_columns(list(columns), a.columns, "columns") if columns else sorted(a.columns)
    ours = comparable_frame(a, names).withColumn("__a", F.lit(1)).withColumn("__b", F.lit(0))
    theirs = comparable_frame(b, resolve_columns(names, b.columns, "columns")).toDF(*names)
    theirs = theirs.withColumn("__a", F.lit(0)).withColumn("__b", F.lit(1))
    counted = ours.unionByName(theirs).groupBy(*[quote(n) for n in names]).agg(
        F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    one_sided = F.when((F.col("__a") == 0) | (F.col("__b") == 0), 1).otherwise(0)
    return counted.agg(
        F.coalesce(F.sum(F.col("__a") - F.col("__b")), F.lit(0)).alias("row_count_difference"),
        F.coalesce(F.sum(one_sided), F.lit(0)).cast("bigint").alias("num_mismatched"),
    )


def rows_differ(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The rows only one side has, copies counted, marked ``actual`` or ``expected``.

    Columns are matched without regard to case; the expected side decides which are compared.
    """
    names = resolve_columns(expected.columns, actual.columns, "expected rows")
    ours = comparable_frame(actual, names)
    kinds = [f.dataType for f in actual.select(*[quote(n) for n in names]).schema]
    theirs = expected.select(*[F.col(quote(e)).cast(k).alias(n)
                               for e, n, k in zip(expected.columns, names, kinds)])
    theirs = comparable_frame(theirs)
    counted = (
        ours.withColumn("__n", F.lit(1)).unionByName(theirs.withColumn("__n", F.lit(-1)))
        .groupBy(*[quote(n) for n in names]).agg(F.sum("__n").alias("__n")).filter("__n <> 0")
    )
    side = F.when(F.col("__n") > 0, "actual").otherwise("expected")
    return counted.select(side.alias("only_in"), F.abs("__n").alias("copies"), *[quote(n) for n in names])


def unit_test(
    model: Callable[..., DataFrame], given: Mapping[str, DataFrame], expect: DataFrame
) -> DataFrame:
    """Run a model on given inputs and return how its rows differ from the expected ones."""
    return rows_differ(model(**given), expect)
