"""Queries that exercise every operator on whole tables, each with its SQL counterpart."""

from tablewright.plans import (  # noqa: F401  (each import registers its queries)
    aggregate, checking, following, history, incremental, maintained, profiling, relational, scalar, stored,
)
from tablewright.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
