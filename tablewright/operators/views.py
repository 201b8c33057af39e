"""Maintained views: a query's result kept as a table and refreshed from changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import tables
from tablewright.guards import required
from tablewright.naming import TableRef, as_list, quote, resolve_columns
from tablewright.operators.comparing import comparable, differ
from tablewright.operators.constraints import Check, enforce
from tablewright.operators.exact import summed, together, total
from tablewright.operators.extremes import counted, exhausted, listed, relisted, same_group as _same_group
from tablewright.sizes import fits_broadcast
from tablewright.tables import Storage

CHANGE_TYPE = "_change_type"


def materialize_mv(
    model: Callable[[], DataFrame],
    ref: TableRef | str,
    *,
    checks: Sequence[Check] = (),
    partitioned_by: Sequence[str] | str | None = None,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    on_demand: bool = False,
    scheduled: bool = False,
    dropped: Observation | None = None,
) -> DataFrame:
    """Store a query's result under a name, replacing a table or view that holds it.

    The view must say how it is refreshed: by calling this again (``on_demand``) or by the
    caller's scheduler doing so (``scheduled``).
    """
    if not (on_demand or scheduled):
        raise ValueError("a maintained view must be refreshed on demand or by a schedule")
    storage = Storage(partition_by=partitioned_by, comment=comment, properties=dict(properties or {}))
    return tables.write_table(enforce(model(), checks, dropped), ref, storage)


def require_table_sources(spark: SparkSession, refs: Sequence[TableRef | str]) -> list[str]:
    """Sources of a maintained view must be tables.  One that is not found is returned as a warning."""
    missing = []
    for ref in map(TableRef.parse, refs):
        kind = tables.table_kind(spark, ref)
        if kind == "view":
            raise ValueError(f"{ref.sql} is a view; changes can only be followed on a table")
        if kind is None:
            missing.append(ref.sql)
    return missing


def change_feed(old: DataFrame, new: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Row changes from one state to the next: ``insert``, ``delete`` and both images of an update.

    The key must be present and unique in each state; the job fails otherwise.  That is seen in the
    partitioning and order the join needs anyway, before a repeated key could multiply.
    """
    keys = resolve_columns(as_list(key), new.columns, "key")
    resolve_columns(new.columns, old.columns, "old state")
    columns = new.columns
    kinds = {f.name: f.dataType for f in new.schema}
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*keys))
    present = reduce(lambda x, y: x & y, [F.col(quote(k)).isNotNull() for k in keys])
    sound = required(present & (F.col("__nth") == 1), "change_feed: the key is not unique or NULL")
    cast = [F.col(quote(c)).cast(kinds[c]).alias(c) for c in columns]
    a = old.select(*cast).withColumn("__nth", nth).filter(sound).alias("a")
    b = new.withColumn("__nth", nth).filter(sound).alias("b")
    same_key = [F.col(f"a.{quote(k)}") == F.col(f"b.{quote(k)}") for k in keys]
    in_a, in_b = F.col("a.__nth").isNotNull(), F.col("b.__nth").isNotNull()
    changed = differ([(comparable(F.col(f"a.{quote(c)}"), kinds[c]), comparable(F.col(f"b.{quote(c)}"), kinds[c]))
                      for c in columns if c not in keys])

    def image(side: str, label: Column) -> Column:
        return F.struct(label.alias(CHANGE_TYPE), *[F.col(f"{side}.{quote(c)}").alias(c) for c in columns])

    both = in_a & in_b
    before = F.when(in_a, image("a", F.when(both, "update_preimage").otherwise("delete")))
    after = F.when(in_b, image("b", F.when(both, "update_postimage").otherwise("insert")))
    return (
        a.join(b, same_key, "full").filter(~both | changed)
        .select(F.explode(F.array(before, after)).alias("__row"))
        .filter(F.col("__row").isNotNull())
        .select("__row.*").select(*columns, CHANGE_TYPE)
    )


@dataclass(frozen=True)
class AggregateView:
    """A grouped aggregate that can be kept up to date from changes.

    ``sums`` maps an output column to the column it adds up; ``count`` names the row count.
    ``extremes`` maps an output column to ``("min" | "max", column)``.  Sums of floating point cannot be
    taken back exactly; like extremes they need the base rows, unless ``exact`` keeps them as whole numbers per
    power of two, which costs the state a map.  With ``kept`` the state lists that many of the
    smallest (largest) values of a group, and the base is read only for a group whose list has run empty.
    """

    group_by: Sequence[str] | str
    sums: Mapping[str, str] = field(default_factory=dict)
    count: str = "n_rows"
    extremes: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    kept: int = 0
    exact: bool = False

    def __post_init__(self) -> None:
        if not as_list(self.group_by):
            raise ValueError("a maintained aggregate needs group_by columns")
        for how, _ in self.extremes.values():
            if how not in ("min", "max"):
                raise ValueError(f"extremes are min or max, got {how!r}")
        if self.kept < 0:
            raise ValueError("kept must not be negative")

    def seen(self, name: str) -> str:
        """State column: how many non-NULL values are in a sum (a sum of none is NULL)."""
        return f"{name}__seen"

    def lists(self) -> dict[str, tuple[str, str]]:
        """State columns of each extreme with a list: the list, and how many rows lie beyond it."""
        return {name: (f"{name}__kept", f"{name}__more") for name in self.extremes} if self.kept else {}

    def parts(self, name: str) -> str:
        """State column: the places of an exact floating sum."""
        return f"{name}__parts"

    def columns(self) -> list[str]:
        return [*as_list(self.group_by), self.count, *self.sums, *self.extremes]


def _floating(state: DataFrame, view: AggregateView) -> list[str]:
    return [f.name for f in state.schema if f.name in view.sums and isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def floating_sums(state: DataFrame, view: AggregateView) -> list[str]:
    """The sums of a state that are plain floating point: adding and subtracting would round, and NaN would stay."""
    return [n for n in _floating(state, view) if not view.exact]


def exact_sums(state: DataFrame, view: AggregateView) -> list[str]:
    """The floating sums of a state that are kept by places."""
    return [n for n in _floating(state, view) if view.exact]


def _sums(view: AggregateView, sign: Column) -> list[Column]:
    result = [F.sum(sign).cast("bigint").alias(view.count)]
    for name, column in view.sums.items():
        value = F.col(quote(column))
        result.append(F.coalesce(F.sum(sign * value), F.lit(0)).alias(name))
        result.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).cast("bigint").alias(view.seen(name)))
    return result


def _extremes(view: AggregateView) -> list[Column]:
    functions = {"min": F.min, "max": F.max}
    return [functions[how](F.col(quote(c))).alias(name) for name, (how, c) in view.extremes.items()]


def aggregate_state(base: DataFrame, view: AggregateView) -> DataFrame:
    """The aggregate with its state columns, from all rows."""
    keys = as_list(view.group_by)
    state = base.groupBy(*keys).agg(*_sums(view, F.lit(1)), *_extremes(view))
    for name, (how, column) in view.extremes.items() if view.kept else ():
        state = _with_list(state, listed(counted(base, keys, column, F.lit(1)), keys, how, view.kept), keys, name, view)
    for name in exact_sums(state, view):
        state = _with_parts(state, summed(base, keys, view.sums[name], F.lit(1)), keys, name, view)
    return state


def _with_parts(state: DataFrame, added: DataFrame, keys: Sequence[str], name: str, view: AggregateView) -> DataFrame:
    """The state with what ``added`` (keys, parts) brings to an exact sum; a new column is empty elsewhere."""
    column = view.parts(name)
    columns = [*state.columns, *([] if column in state.columns else [column])]
    had = F.col(f"s.{quote(column)}") if column in state.columns else F.lit(None).cast("map<int,bigint>")
    new = state.alias("s").join(added.alias("d"), _same_group("s", "d", keys), "left").select(
        *[together(had, F.col("d.parts")).alias(c) if c == column else F.col(f"s.{quote(c)}") for c in columns])
    return new.select(*[total(F.col(quote(column))).alias(c) if c == name else F.col(quote(c)) for c in columns])


def _with_list(state: DataFrame, lists: DataFrame, keys: Sequence[str], name: str, view: AggregateView) -> DataFrame:
    """The state with new lists where ``lists`` (keys, list, more) has the group; a new column is empty elsewhere."""
    kept, more = view.lists()[name]
    kind = lists.schema["list"].dataType
    had = {kept: F.col(f"s.{quote(kept)}"), more: F.col(f"s.{quote(more)}")} if kept in state.columns else {}
    new = F.col("l.more").isNotNull()
    made = {
        kept: F.when(new, F.col("l.list")).otherwise(F.coalesce(had.get(kept, F.lit(None)), F.array().cast(kind))),
        more: F.when(new, F.col("l.more")).otherwise(F.coalesce(had.get(more, F.lit(None)), F.lit(0)).cast("bigint")),
        name: F.when(new, F.get(F.col("l.list"), F.lit(0))["value"]).otherwise(F.col(f"s.{quote(name)}")),
    }
    columns = [*state.columns, *[c for c in (kept, more) if c not in state.columns]]
    return state.alias("s").join(lists.alias("l"), _same_group("s", "l", keys), "left").select(
        *[made[c].alias(c) if c in made else F.col(f"s.{quote(c)}").alias(c) for c in columns])


def aggregate_result(state: DataFrame, view: AggregateView) -> DataFrame:
    """The user's columns of a state."""
    shown = [F.when(F.col(quote(view.seen(c))) > 0, F.col(quote(c))).alias(c) if c in view.sums else F.col(quote(c))
             for c in view.columns()]
    return state.select(*shown)


def apply_changes(
    state: DataFrame, changes: DataFrame, view: AggregateView, base: DataFrame | None = None
) -> DataFrame:
    """The state after a change feed.

    Changes are summed per group with their sign before anything is joined, so both sides of the
    join have one row per group.  A minimum or maximum cannot be taken back, so groups that lost a
    row are recomputed from ``base`` (the rows after the changes); only those are read again.  With a
    floating sum that is not exact it is done for every group that changed.  Extremes with lists are taken from these, without
    ``base``; see ``refresh_incremental`` for lists that run empty.
    """
    keys = as_list(view.group_by)
    exact = exact_sums(state, view)
    if exact:
        rest = [view.parts(n) for n in exact]
        new = _carried(state, _changed(state.drop(*rest), changes, view, base), keys, rest)
        sign = F.when(F.col(CHANGE_TYPE).isin("delete", "update_preimage"), -1).otherwise(1)
        for name in exact:
            new = _with_parts(new, summed(changes, keys, view.sums[name], sign), keys, name, view)
        return new.select(*state.columns)
    return _changed(state, changes, view, base)


def _changed(state: DataFrame, changes: DataFrame, view: AggregateView, base: DataFrame | None) -> DataFrame:
    """``apply_changes`` but for exact sums, whose doubles it leaves wrong."""
    keys = as_list(view.group_by)
    if view.kept and view.extremes:
        plain = replace(view, extremes={}, kept=0)
        rest = [c for name, two in view.lists().items() for c in (name, *two)]
        summed = _carried(state, _changed(state.drop(*rest), changes, plain, base), keys, rest)
        sign = F.when(F.col(CHANGE_TYPE).isin("delete", "update_preimage"), -1).otherwise(1)
        for name, (how, column) in view.extremes.items():
            lists = relisted(state, changes, keys, column, how, view.kept, view.lists()[name], sign)
            summed = _with_list(summed, lists, keys, name, view)
        return summed.select(*state.columns)
    gone = F.col(CHANGE_TYPE).isin("delete", "update_preimage")
    sign = F.when(gone, -1).otherwise(1)
    floating = floating_sums(state, view)
    lost = (F.lit(1) if floating else F.max(F.when(gone, 1).otherwise(0))).alias("__lost")
    functions = {"min": F.min, "max": F.max}
    arrivals = [functions[how](F.when(~gone, F.col(quote(c)))).alias(name)
                for name, (how, c) in view.extremes.items()]
    delta = changes.groupBy(*keys).agg(*_sums(view, sign), *arrivals, lost)

    added = [view.count, *[n for s in view.sums for n in (s, view.seen(s))]]
    old, new = state.withColumn("__in", F.lit(True)).alias("old"), delta.withColumn("__in", F.lit(True)).alias("new")
    both = old.join(new, _same_group("old", "new", keys), "full")
    picked = [F.when(F.col("new.__in"), F.col(f"new.{quote(k)}")).otherwise(F.col(f"old.{quote(k)}")).alias(k)
              for k in keys]
    kinds = {f.name: f.dataType for f in state.schema}
    picked += [
        (F.coalesce(F.col(f"old.{quote(c)}"), F.lit(0)) + F.coalesce(F.col(f"new.{quote(c)}"), F.lit(0)))
        .cast(kinds[c]).alias(c) for c in added]
    pick = {"min": F.least, "max": F.greatest}
    picked += [pick[how](F.col(f"old.{quote(n)}"), F.col(f"new.{quote(n)}")).alias(n)
               for n, (how, _) in view.extremes.items()]
    merged = both.select(*picked, F.coalesce(F.col("new.__lost"), F.lit(0)).alias("__lost"))
    merged = merged.filter(F.col(quote(view.count)) > 0)
    recomputed = [*view.extremes, *floating]
    if not recomputed:
        return merged.select(*state.columns)
    if base is None:
        raise ValueError("min, max and floating sums need the base rows, to recompute groups that lost one")
    touched = delta.filter("__lost = 1").select(*keys).alias("t")
    if fits_broadcast(changes):
        touched = F.broadcast(touched)
    again = (
        base.alias("b").join(touched, _same_group("b", "t", keys), "left_semi")
        .groupBy(*keys).agg(*_extremes(view), *[
            F.coalesce(F.sum(F.col(quote(view.sums[n]))), F.lit(0)).cast(kinds[n]).alias(n) for n in floating]).alias("again")
    )
    fixed = merged.alias("m").join(again, _same_group("m", "again", keys), "left")
    return fixed.select(*[
        F.when(F.col("m.__lost") == 1, F.col(f"again.{quote(c)}")).otherwise(F.col(f"m.{quote(c)}")).alias(c)
        if c in recomputed else F.col(f"m.{quote(c)}").alias(c)
        for c in state.columns])


def _carried(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``new`` with columns of the same groups in ``old``."""
    both = new.alias("n").join(old.select(*[F.col(quote(c)) for c in (*keys, *columns)]).alias("o"), _same_group("n", "o", keys), "left")
    return both.select(*[F.col(f"n.{quote(c)}").alias(c) for c in new.columns], *[F.col(f"o.{quote(c)}").alias(c) for c in columns])


def _refilled(state: DataFrame, base: DataFrame | None, view: AggregateView) -> DataFrame:
    """The state with lists made anew from ``base`` for the groups with one that has run empty, if there are any."""
    keys = as_list(view.group_by)
    empty = exhausted(state, list(view.lists().values()))
    if empty.isEmpty():
        return state
    if base is None:
        raise ValueError("a list of extremes has run empty: the base rows are needed once, or a larger kept")
    rows = base.alias("b").join(empty.select(*[F.col(quote(k)) for k in keys]).alias("e"), _same_group("b", "e", keys), "left_semi")
    for name, (how, column) in view.extremes.items():
        state = _with_list(state, listed(counted(rows, keys, column, F.lit(1)), keys, how, view.kept), keys, name, view)
    return state


def create_aggregate(base: DataFrame, ref: TableRef | str, view: AggregateView) -> DataFrame:
    """Store the state of a maintained aggregate; ``aggregate_result`` shows it."""
    return tables.write_table(aggregate_state(base, view), ref)


def refresh_incremental(
    ref: TableRef | str, changes: DataFrame, view: AggregateView,
    base: DataFrame | None = None, tag: str | None = None,
) -> DataFrame:
    """Bring a stored aggregate up to date from changes alone.

    With extremes or floating sums the changes are read twice, so they are stored beside the state first.  Extremes
    with lists read ``base`` only if a list has run empty, and fail without it before the stored state is touched.
    """
    ref = TableRef.parse(ref)
    spark = changes.sparkSession
    tables.require_table(spark, ref)
    state = tables.fresh(spark, ref)
    twice = view.extremes or _floating(state, view)
    with tables.staged(changes, ref) if twice else nullcontext(changes) as feed:
        after = apply_changes(state, feed, view, base)
        if not view.lists():
            return tables.rewrite(after, ref, tag)
        with tables.staged(after, ref) as new:
            return tables.rewrite(_refilled(new, base, view), ref, tag)
