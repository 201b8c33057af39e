"""Aggregate functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.naming import as_list, quote


def any_value(value: Column) -> Column:
    """Some value of the group; a NULL is a value like any other."""
    return F.any_value(value)


def bool_or(flag: Column) -> Column:
    return F.bool_or(flag)


def listagg(value: Column, delimiter: str = ",", order_by: Sequence[Column] = (), limit: int | None = None) -> Column:
    """The group's values joined to one text, NULL left out, in the given order (else by value).

    The list is built inside the group, so this is for groups known to be small, such as the lines
    of an order.  ``listagg_rows`` does the same for groups of any size.
    """
    keys = [k.alias(f"k{i}") for i, k in enumerate(order_by)]
    entries = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*keys, value.cast("string").alias("v")))))
    if limit is not None:
        entries = F.slice(entries, 1, limit)
    return F.array_join(F.transform(entries, lambda e: e.getField("v")), delimiter)


def listagg_rows(
    df: DataFrame,
    group_by: Sequence[str] | str,
    value: str,
    output: str,
    delimiter: str = ",",
    order_by: Sequence[str] | str | None = None,
    limit: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """``listagg`` for groups of any size: one row per group with the joined text, empty if all values are NULL.

    No task sorts or collects the rows of a whole group.  Rows are range-partitioned by group and
    order, so a hot group is spread over many tasks; each task joins its own stretch to one text,
    and only those few texts per group meet in the last step.  ``distinct`` removes copies before
    that.  With ``limit`` only the first rows of a group are shuffled to it, and joined at once.

    The result is one text per group, so a single result must fit Spark's cell size (2 GB).
    """
    groups, order = as_list(group_by), as_list(order_by)
    if distinct and order and order != [value]:
        raise ValueError("a distinct list can only be ordered by its value")
    order = order or [value]
    columns = [*groups, *dict.fromkeys([*order, value])]
    rows = df.select(*[quote(c) for c in columns])
    if distinct:
        rows = rows.distinct()
    sequence = list(dict.fromkeys([*order, value]))
    if limit is not None:
        return _first_rows(rows, groups, value, sequence, limit).groupBy(*groups).agg(
            _joined(sequence, value, delimiter).alias(output))
    # Rows that are equal in group and order stay in one stretch.
    spread = rows.repartitionByRange(*groups, *sequence).withColumn("__stretch", F.spark_partition_id())
    text = F.when(F.count(F.col(quote(value))) > 0, _joined(sequence, value, delimiter))
    stretches = spread.groupBy(*groups, "__stretch").agg(text.alias("__text"))
    return stretches.groupBy(*groups).agg(_joined(["__stretch", "__text"], "__text", delimiter).alias(output))


def _joined(sequence: Sequence[str], value: str, delimiter: str) -> Column:
    """The collected values in order, as one text; NULL values are left out."""
    entry = F.struct(*[F.col(quote(c)) for c in sequence])
    entries = F.array_sort(F.collect_list(F.when(F.col(quote(value)).isNotNull(), entry)))
    return F.array_join(F.transform(entries, lambda e: e.getField(value).cast("string")), delimiter)


# Up to here Spark itself drops rows beyond the rank before the shuffle.
_RANKED_BEFORE_SHUFFLE = 1000


def _first_rows(rows: DataFrame, groups: Sequence[str], value: str, sequence: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, NULL values last.  A long list is found in two steps: first among
    the rows that one task has read, so that no task ranks all rows of a hot group."""
    def ranked(df: DataFrame, *keys: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(quote(value)).isNull(), *sequence))
        return df.withColumn("__rank", rank).filter(F.col("__rank") <= limit).drop("__rank")

    if limit > _RANKED_BEFORE_SHUFFLE:
        rows = ranked(rows.withColumn("__share", F.spark_partition_id()), *groups, "__share").drop("__share")
    return ranked(rows, *groups)
