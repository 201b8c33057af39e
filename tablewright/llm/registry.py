"""The queries of this subpackage, kept apart from those of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.files import parquet_table

Run = Callable[[SparkSession, str], DataFrame]

_RUNS: dict[str, Run] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query, with the SQL that must give the same rows where SQL can say it."""
    def add(run: Run) -> Run:
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
