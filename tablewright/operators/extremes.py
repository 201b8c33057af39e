"""Minima and maxima that can be taken back: per group a bounded list of the best values with their counts.

The list of a minimum holds the smallest values, that of a maximum the largest, best first, each with the number of
rows that have it; ``more`` says how many rows lie beyond.  Every row up to the last listed value is in the list, so a
deletion takes the next value from it.  Only a list that runs empty while rows lie beyond needs the base again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.naming import quote

_VALUE, _N = "__value", "__n"


def same_group(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{quote(k)}").eqNullSafe(F.col(f"{right}.{quote(k)}")) for k in keys])


def _cols(keys: Sequence[str]) -> list[Column]:
    return [F.col(quote(k)) for k in keys]


def counted(rows: DataFrame, keys: Sequence[str], column: str, weight: Column) -> DataFrame:
    """The keys, a value and the sum of its weights: one row per group and value that is not NULL.  A hot group is
    counted by value before it is shuffled and lies in many tasks after."""
    value = F.col(quote(column))
    return rows.filter(value.isNotNull()).groupBy(*_cols(keys), value.alias(_VALUE)).agg(F.sum(weight).cast("bigint").alias(_N)) \
        .filter(f"{_N} <> 0")


def listed(values: DataFrame, keys: Sequence[str], how: str, kept: int, plus: DataFrame | None = None) -> DataFrame:
    """The keys, list and more, from what ``counted`` gives; ``plus`` has the keys and an ``__n`` of further rows beyond."""
    best = F.col(_VALUE).asc() if how == "min" else F.col(_VALUE).desc()
    top = values.withColumn("__rank", F.row_number().over(W.partitionBy(*_cols(keys)).orderBy(best))).filter(f"__rank <= {kept}")
    entry = F.struct(F.col(_VALUE).alias("value"), F.col(_N).alias("n"))
    lists = top.groupBy(*_cols(keys)).agg(F.sort_array(F.collect_list(entry), asc=how == "min").alias("list"), (-F.sum(_N)).alias(_N))
    nothing = F.lit(None).cast(lists.schema["list"].dataType).alias("list")
    parts = [lists, *[p.select(*_cols(keys), nothing, _N) for p in (values, plus) if p is not None]]
    merged = reduce(DataFrame.unionByName, parts).groupBy(*_cols(keys)).agg(
        F.first("list", ignorenulls=True).alias("list"), F.sum(_N).cast("bigint").alias("more"))
    return merged.withColumn("list", F.coalesce("list", F.array().cast(lists.schema["list"].dataType)))


def relisted(state: DataFrame, changes: DataFrame, keys: Sequence[str], column: str, how: str, kept: int,
             names: tuple[str, str], sign: Column) -> DataFrame:
    """The keys, list and more after a change feed, of the groups whose values it touches.

    ``names``: the state's columns of list and more.  Changes beyond a list's last value are only counted.
    """
    old = state.select(*_cols(keys), F.col(quote(names[0])).alias("__list"), F.col(quote(names[1])).alias("__more"))
    delta = counted(changes, keys, column, sign)
    last = F.get(F.col("o.__list"), F.size("o.__list") - 1)["value"]
    edge = F.when(F.col("o.__more") > 0, last)
    value = F.col(f"d.{_VALUE}")
    inside = edge.isNull() | (value <= edge if how == "min" else value >= edge)
    judged = delta.alias("d").join(old.alias("o"), same_group("d", "o", keys), "left").select(
        *[F.col(f"d.{quote(k)}").alias(k) for k in keys], value.alias(_VALUE), F.col(f"d.{_N}").alias(_N), inside.alias("__inside"))
    touched = old.alias("o").join(delta.select(*_cols(keys)).distinct().alias("t"), same_group("o", "t", keys), "left_semi")
    entries = touched.select(*_cols(keys), F.explode("__list").alias("__entry")).select(
        *_cols(keys), F.col("__entry.value").alias(_VALUE), F.col("__entry.n").alias(_N))
    values = entries.unionByName(judged.filter("__inside").drop("__inside")).groupBy(*_cols(keys), _VALUE).agg(
        F.sum(_N).cast("bigint").alias(_N)).filter(f"{_N} <> 0")
    beyond = judged.filter("not __inside").select(*_cols(keys), _N).unionByName(touched.select(*_cols(keys), F.col("__more").alias(_N)))
    return listed(values, keys, how, kept, beyond)


def exhausted(state: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    """The groups with an empty list and rows beyond it."""
    return state.filter(reduce(lambda x, y: x | y, [(F.size(quote(a)) == 0) & (F.col(quote(b)) > 0) for a, b in names]))
