"""The list of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.files import parquet_table

Run = Callable[[SparkSession, str], DataFrame]

_RUNS: dict[str, Run] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under a name, with the SQL that must give the same rows."""
    def add(run: Run) -> Run:
        if name in _RUNS:
            raise ValueError(f"query {name} is registered twice")
        _RUNS[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return run
    return add


def queries() -> dict[str, Run]:
    return dict(_RUNS)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(spark, sf_dir, name)


def cents(column: str) -> Column:
    """An amount as whole cents, so that sums are exact."""
    return F.round(F.col(column) * 100).cast("bigint")
