"""Building a model with all that goes with it: contract, row constraints, data tests, comments, hooks, source check.

The same ``Model`` is built as a table, a view, an incremental table, a history, a seed or a maintained view.  The order
is always: sources are checked, ``pre`` hooks run, the rows are shaped and stored, comments are written, data tests
run on what is stored, ``post`` hooks run.  A broken contract or constraint leaves the stored rows as they were.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from tablewright import tables
from tablewright.naming import TableRef, quote, sql_text
from tablewright.operators import checks as data_tests
from tablewright.operators.constraints import Check, contract, enforce
from tablewright.operators.incremental import build_incremental
from tablewright.operators.profile import persist_docs
from tablewright.operators.snapshot import SnapshotConfig, snapshot
from tablewright.operators.views import materialize_mv, require_table_sources
from tablewright.sources.seeds import seed
from tablewright.tables import Storage


class TestsFailed(Exception):
    """Stored rows that fail a data test; ``failures`` has their number by test."""

    __test__ = False

    def __init__(self, failures: Mapping[str, int]):
        super().__init__("; ".join(f"{name}: {n} failing rows" for name, n in failures.items()))
        self.failures = dict(failures)


@dataclass(frozen=True)
class Model:
    """What goes with a stored model, however it is stored.

    ``tests`` maps a name to a function from the stored rows to the failing ones.  ``sources`` are the tables a
    model reads: one that is not found is a warning, and a view among them is refused where changes are followed.
    """

    ref: TableRef | str
    contract: T.StructType | str | None = None
    checks: Sequence[Check] = ()
    tests: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    description: str | None = None
    columns: Mapping[str, str] = field(default_factory=dict)
    sources: Sequence[TableRef | str] = ()
    pre: Sequence[Callable[[], object]] = ()
    post: Sequence[Callable[[], object]] = ()

    @property
    def table(self) -> TableRef:
        return TableRef.parse(self.ref)

    def shaped(self, df: DataFrame, dropped: Observation | None = None) -> DataFrame:
        """The rows in the contract's columns that satisfy the constraints."""
        return enforce(df if self.contract is None else contract(df, self.contract), self.checks, dropped)


@contextmanager
def _around(spark: SparkSession, model: Model, followed: bool = False, comments: bool = True) -> Iterator[None]:
    if followed:
        missing = require_table_sources(spark, model.sources)
    else:
        missing = [s.sql for s in map(TableRef.parse, model.sources) if tables.table_kind(spark, s) is None]
    for name in missing:
        warnings.warn(f"{model.table.sql}: source {name} was not found", stacklevel=4)
    for hook in model.pre:
        hook()
    yield
    if comments and (model.description is not None or model.columns):
        persist_docs(spark, model.table, model.description, model.columns)
    run_tests(spark, model)
    for hook in model.post:
        hook()


def run_tests(spark: SparkSession, model: Model) -> None:
    """Run a model's data tests on its stored rows; all of them are run before any failure is reported."""
    stored = tables.fresh(spark, model.table) if model.tests else None
    counts = {name: data_tests.evaluate(test(stored)).first()["failures"] for name, test in model.tests.items()}
    failed = {name: n for name, n in counts.items() if n}
    if failed:
        raise TestsFailed(failed)


def build_table(spark: SparkSession, model: Model, rows: Callable[[], DataFrame], storage: Storage = Storage(),
                dropped: Observation | None = None) -> DataFrame:
    with _around(spark, model):
        tables.write_table(model.shaped(rows(), dropped), model.table, storage)
    return tables.fresh(spark, model.table)


def view_text(spark: SparkSession, model: Model, query: str) -> str:
    """The query with the contract's columns in its order and the constraints as conditions.

    A ``FAIL`` constraint of a view is judged whenever the view is read.
    """
    columns = model.shaped(spark.sql(query)).columns
    tests = []
    for check in model.checks:
        holds = f"coalesce(({check.expression}), false)"
        if check.on_mismatch == "FAIL":
            # As ``guards.required``: it names the running task, so that it stays where it is.
            broken = sql_text(f"constraint {check.label} violated: {check.expression}")
            holds = f"CASE WHEN {holds} OR spark_partition_id() < 0 THEN true ELSE CAST(raise_error({broken}) AS BOOLEAN) END"
            tests.append(holds)
        else:
            tests.insert(0, holds)
    # Rows that are dropped are gone before a FAIL constraint judges the rest.
    text = f"SELECT {', '.join(map(quote, columns))} FROM ({query})"
    for n, test in enumerate(tests):
        text = f"{text} WHERE {test}" if n == 0 else f"SELECT * FROM ({text}) WHERE {test}"
    return text


def build_view(spark: SparkSession, model: Model, query: str) -> DataFrame:
    with _around(spark, model, comments=False):
        tables.materialize_view(spark, view_text(spark, model, query), model.table, model.description, model.columns)
    return spark.table(model.table.sql)


def build_increment(spark: SparkSession, model: Model, rows: Callable[[bool], DataFrame], **how: object) -> DataFrame:
    """``how`` is that of ``build_incremental``: strategy, key, storage, schema change and so on."""
    with _around(spark, model):
        build_incremental(spark, model.table, lambda again: model.shaped(rows(again)), **how)
    return tables.fresh(spark, model.table)


def build_snapshot(spark: SparkSession, model: Model, source: Callable[[], DataFrame], config: SnapshotConfig,
                   now: datetime | str, **how: object) -> DataFrame:
    """The contract and the constraints are those of the source; the history adds its own columns."""
    with _around(spark, model):
        snapshot(model.shaped(source()), model.table, config, now, **how)
    return tables.fresh(spark, model.table)


def build_seed(spark: SparkSession, model: Model, path: str, storage: Storage = Storage(), **how: object) -> DataFrame:
    """The file is loaded beside the table first where a contract or constraints judge it."""
    with _around(spark, model):
        if model.contract is None and not model.checks:
            seed(spark, path, model.table, storage=storage, **how)
        else:
            loaded = model.table.sibling(f"{model.table.name}__loaded")
            try:
                tables.write_table(model.shaped(seed(spark, path, loaded, **how)), model.table, storage)
            finally:
                tables.drop(spark, loaded)
    return tables.fresh(spark, model.table)


def build_maintained(spark: SparkSession, model: Model, rows: Callable[[], DataFrame], **how: object) -> DataFrame:
    """A maintained view; its sources must be tables, since changes can only be followed on these."""
    with _around(spark, model, followed=True):
        materialize_mv(lambda: model.shaped(rows()), model.table, comment=model.description, **how)
    return tables.fresh(spark, model.table)
