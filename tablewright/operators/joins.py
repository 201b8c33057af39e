"""Joins that follow changes on both sides.

The change of a join is the changes of the left side with the new right side, and the new left side with the changes of
the right, less the changes of both with each other, which the first two count twice.  With signs on the rows this is
one sum, and only keys that changed are looked up on the other side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.naming import TableRef, as_list, quote
from tablewright.operators.views import CHANGE_TYPE

_SIGN = "__sign"


@dataclass(frozen=True)
class JoinView:
    """An inner join kept as a table.

    ``on`` pairs a left column with a right one (NULL meets nothing); ``columns`` names each output column and where it
    comes from, ``("left" | "right", column)``; ``key`` are output columns that tell the rows of the join apart.
    """

    on: Mapping[str, str]
    columns: Mapping[str, tuple[str, str]]
    key: Sequence[str] | str

    def __post_init__(self) -> None:
        if not self.on:
            raise ValueError("a maintained join needs a pair of columns to join on")
        if not as_list(self.key) or not set(as_list(self.key)) <= set(self.columns):
            raise ValueError("the key of a maintained join must be some of its columns")
        if any(side not in ("left", "right") for side, _ in self.columns.values()):
            raise ValueError("columns come from left or right")

    def used(self, side: str) -> list[str]:
        """The columns of one side that the join reads."""
        on = list(self.on) if side == "left" else list(self.on.values())
        return list(dict.fromkeys([*on, *[c for s, c in self.columns.values() if s == side]]))


def _joined(left: DataFrame, right: DataFrame, view: JoinView, *more: Column) -> DataFrame:
    same = reduce(lambda a, b: a & b, [F.col(f"l.{quote(a)}") == F.col(f"r.{quote(b)}") for a, b in view.on.items()])
    side = {"left": "l", "right": "r"}
    picked = [F.col(f"{side[s]}.{quote(c)}").alias(name) for name, (s, c) in view.columns.items()]
    return left.alias("l").join(right.alias("r"), same).select(*picked, *more)


def joined(left: DataFrame, right: DataFrame, view: JoinView) -> DataFrame:
    """The join from all rows."""
    return _joined(left, right, view)


def _signed(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What the changes amount to, in the columns that the join reads: rows and how often they came (or went)."""
    sign = F.when(F.col(CHANGE_TYPE).isin("delete", "update_preimage"), -1).otherwise(1)
    names = [F.col(quote(c)) for c in columns]
    return changes.select(*names, sign.alias(_SIGN)).groupBy(*names).agg(F.sum(_SIGN).cast("bigint").alias(_SIGN)).filter(f"{_SIGN} <> 0")


def join_changes(left: DataFrame, left_changes: DataFrame, right: DataFrame, right_changes: DataFrame, view: JoinView) -> DataFrame:
    """The change feed of the join: ``insert`` and ``delete`` rows.

    ``left`` and ``right`` are the sides after their changes.  A row that both goes and comes unchanged is not in the
    feed; one that is there several times is so in the feed.
    """
    sides = {"left": left.select(*[F.col(quote(c)) for c in view.used("left")]),
             "right": right.select(*[F.col(quote(c)) for c in view.used("right")])}
    delta_left, delta_right = _signed(left_changes, view.used("left")), _signed(right_changes, view.used("right"))
    terms = [
        _joined(delta_left, sides["right"], view, F.col(f"l.{_SIGN}").alias(_SIGN)),
        _joined(sides["left"], delta_right, view, F.col(f"r.{_SIGN}").alias(_SIGN)),
        _joined(delta_left, delta_right, view, (-F.col(f"l.{_SIGN}") * F.col(f"r.{_SIGN}")).alias(_SIGN)),
    ]
    names = [F.col(quote(c)) for c in view.columns]
    net = reduce(DataFrame.unionByName, terms).groupBy(*names).agg(F.sum(_SIGN).cast("bigint").alias(_SIGN)).filter(f"{_SIGN} <> 0")
    copies = F.explode(F.sequence(F.lit(1), F.abs(_SIGN).cast("int"))).alias("__copy")
    kind = F.when(F.col(_SIGN) > 0, "insert").otherwise("delete").alias(CHANGE_TYPE)
    return net.select(*names, kind, copies).select(*names, CHANGE_TYPE)


def apply_join_changes(state: DataFrame, changes: DataFrame, view: JoinView) -> DataFrame:
    """The stored join after a feed of ``join_changes``: rows whose key was deleted go, inserted ones come."""
    keys = as_list(view.key)
    gone = changes.filter(F.col(CHANGE_TYPE) == "delete").select(*[F.col(quote(k)) for k in keys]).distinct().alias("g")
    same = reduce(lambda a, b: a & b, [F.col(f"s.{quote(k)}").eqNullSafe(F.col(f"g.{quote(k)}")) for k in keys])
    names = [F.col(quote(c)) for c in state.columns]
    return state.alias("s").join(gone, same, "left_anti").select(*names).unionByName(
        changes.filter(F.col(CHANGE_TYPE) == "insert").select(*names))


def create_join(left: DataFrame, right: DataFrame, ref: TableRef | str, view: JoinView) -> DataFrame:
    return tables.write_table(joined(left, right, view), ref)


def refresh_join(ref: TableRef | str, left: DataFrame, left_changes: DataFrame, right: DataFrame, right_changes: DataFrame,
                 view: JoinView) -> DataFrame:
    """Bring a stored join up to date.  Its changes are stored beside it first: they are read twice."""
    ref = TableRef.parse(ref)
    spark = left.sparkSession
    tables.require_table(spark, ref)
    with tables.staged(join_changes(left, left_changes, right, right_changes, view), ref) as feed:
        return tables.rewrite(apply_join_changes(tables.fresh(spark, ref), feed, view), ref)
