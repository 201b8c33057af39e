"""Refreshing a stored view in the cheapest way that gives the right rows.

The versions of the sources that a view holds are part of its directory's name, so rows and versions change in one
catalog update.  Where the sources are still at these, nothing is done; where their logs cover the gap, the changes
are applied; else the view is built anew.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tablewright import tables
from tablewright.naming import TableRef
from tablewright.operators.changelog import VERSION, changes_between, covers, version
from tablewright.tables import Storage

SKIPPED, INCREMENTAL, FULL = "skipped", "incremental", "full"
_HELD = re.compile(r"_w([0-9a-f]{10})n(\d+)")


def _mark(source: TableRef) -> str:
    return hashlib.sha256(source.sql.lower().encode()).hexdigest()[:10]


def held_versions(spark: SparkSession, ref: TableRef | str) -> dict[str, int]:
    """The versions of its sources that a stored view holds, by the marks of their names; empty where it does not say."""
    ref = TableRef.parse(ref)
    if tables.table_kind(spark, ref) != "table":
        return {}
    return {mark: int(number) for mark, number in _HELD.findall(tables.version_tag(spark, ref))}


def refresh(
    spark: SparkSession,
    ref: TableRef | str,
    sources: Mapping[str, TableRef | str],
    full: Callable[[Mapping[str, DataFrame]], DataFrame],
    incremental: Callable[[DataFrame, Mapping[str, DataFrame], Mapping[str, DataFrame]], DataFrame | None] | None = None,
    storage: Storage = Storage(),
) -> str:
    """Bring a view up to date, and say how: ``skipped``, ``incremental`` or ``full``.

    ``sources`` names logged tables.  ``full`` gives the view's rows from the sources; ``incremental`` gives them
    from the view's present rows, the change feeds and the sources, or None if it cannot.  A view that was made for
    other sources, by other means or not at all is built in full.  The skip reads the catalog only and runs no job.
    """
    ref, refs = TableRef.parse(ref), {name: TableRef.parse(source) for name, source in sources.items()}
    if storage.partition_by:
        raise ValueError("a view that follows versions is replaced as a whole and cannot be partitioned")
    now = {name: version(spark, source) for name, source in refs.items()}
    held = held_versions(spark, ref)
    if held == {_mark(refs[name]): number for name, number in now.items()}:
        return SKIPPED
    old_tag = tables.version_tag(spark, ref) if held else ""
    tag = _HELD.sub("", old_tag) + "".join(f"_w{_mark(refs[name])}n{number}" for name, number in sorted(now.items()))
    rows = {name: tables.fresh(spark, source) for name, source in refs.items()}
    since = {name: held.get(_mark(source)) for name, source in refs.items()}
    if incremental and len(held) == len(refs) and all(
            n is not None and covers(spark, refs[name], n) for name, n in since.items()):
        feeds = {name: changes_between(spark, refs[name], n, now[name]).drop(VERSION) for name, n in since.items()}
        after = incremental(tables.fresh(spark, ref), feeds, rows)
        if after is not None:
            tables.rewrite(after, ref, tag)
            return INCREMENTAL
    tables.write_table(full(rows), ref, storage, tag)
    return FULL
