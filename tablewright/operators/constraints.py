"""Contracts on columns and constraints on rows, enforced before a table is published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.guards import required
from tablewright.naming import quote


def contract(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The columns in the contract's order; other names or types are an error."""
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    ours = {f.name.lower(): f for f in df.schema}
    problems = [f"missing {f.name}" for f in wanted if f.name.lower() not in ours]
    problems += [f"unexpected {f.name}" for f in df.schema
                 if f.name.lower() not in {w.name.lower() for w in wanted}]
    problems += [
        f"{f.name} is {ours[f.name.lower()].dataType.simpleString()}, contract says {f.dataType.simpleString()}"
        for f in wanted if f.name.lower() in ours and ours[f.name.lower()].dataType != f.dataType
    ]
    if problems:
        raise ValueError("contract broken: " + "; ".join(problems))
    return df.select(*[F.col(quote(ours[f.name.lower()].name)).alias(f.name) for f in wanted])


@dataclass(frozen=True)
class Check:
    """A condition every row must satisfy; NULL does not satisfy it."""

    expression: str
    name: str | None = None
    on_mismatch: str = "FAIL"

    def __post_init__(self) -> None:
        if self.on_mismatch not in ("FAIL", "DROP"):
            raise ValueError("on_mismatch must be FAIL or DROP")

    @property
    def label(self) -> str:
        return self.name or md5(self.expression.encode()).hexdigest()

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.expression), F.lit(False))


def not_null_check(column: str, on_mismatch: str = "FAIL") -> Check:
    return Check(f"{quote(column)} IS NOT NULL", f"{column}_not_null", on_mismatch)


def enforce(df: DataFrame, checks: Sequence[Check], dropped: Observation | None = None) -> DataFrame:
    """The rows that satisfy all checks.

    A row failing a ``DROP`` check is left out; one failing a ``FAIL`` check ends the job that
    reads the result.  The test is a filter, which (unlike a column) is never pruned.  ``dropped``
    receives the number of rows each ``DROP`` check rejects, counted in the same pass.
    """
    dropping = [c for c in checks if c.on_mismatch == "DROP"]
    if dropped is not None and dropping:
        df = df.observe(dropped, *[F.count(F.when(~c.holds(), 1)).alias(c.label) for c in dropping])
    for check in dropping:
        df = df.filter(check.holds())
    for check in checks:
        if check.on_mismatch == "FAIL":
            df = df.filter(required(check.holds(), f"constraint {check.label} violated: {check.expression}"))
    return df


def checks_from(configs: Sequence[Mapping[str, str]]) -> list[Check]:
    """Checks from name / expression / on_mismatch mappings."""
    return [Check(c["expression"], c.get("name"), c.get("on_mismatch", "FAIL")) for c in configs]
