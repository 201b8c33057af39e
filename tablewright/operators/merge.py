"""Keyed upsert: the batch's rows update matching target rows, the others are added.

``merge`` is a plain transform of two DataFrames; ``merge_into`` stores its result.
No step is a full outer join: the target takes part only as the streamed side of a
left join, where a small batch is broadcast (the target is then never shuffled) and
where adaptive execution may split a hot key when the batch is large.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.guards import required
from tablewright.naming import TableRef, as_list, quote, resolve_columns
from tablewright.sizes import fits_broadcast

DEFAULT_ALIASES = ("target", "source")
DUPLICATE_MATCH = "merge: more than one batch row matches the same target row"


def update_list(
    columns: Sequence[str],
    keys: Sequence[str],
    update_columns: Sequence[str] | str | None = None,
    exclude_columns: Sequence[str] | str | None = None,
) -> list[str]:
    """The target columns a matched row takes from the batch."""
    only, without = as_list(update_columns), as_list(exclude_columns)
    if only and without:
        raise ValueError("give update_columns or exclude_columns, not both")
    if only:
        return resolve_columns(only, columns, "update_columns")
    dropped = {c.lower() for c in without}
    return [c for c in columns if c.lower() not in dropped]


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _mentions(test: str, alias: str) -> bool:
    return re.search(rf"\b{re.escape(alias)}`?\s*\.", test, re.IGNORECASE) is not None


def _resolves(df: DataFrame, test: str) -> bool:
    try:
        df.filter(F.expr(test))
        return True
    except AnalysisException:
        return False


def _split_predicates(
    target: DataFrame, batch: DataFrame, predicates: Sequence[str], dest: str, src: str
) -> tuple[list[str], list[str], list[str]]:
    """Sort the extra conditions by the side they look at: target, batch, or both.

    A condition put under both is merely slower, so the names in its text may decide the rest.
    """
    on_target, on_batch, on_both = [], [], []
    for test in predicates:
        if not _mentions(test, src) and _mentions(test, dest) and _resolves(target, test):
            on_target.append(test)
        elif not _mentions(test, dest) and _mentions(test, src) and _resolves(batch, test):
            on_batch.append(test)
        else:
            on_both.append(test)
    return on_target, on_batch, on_both


def repeated_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys the batch has more than once, or None.

    Looked at before anything is joined (key columns only, counted before the shuffle), because a
    repeated key that is hot on both sides would multiply.
    """
    repeated = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*keys)
    return None if repeated.isEmpty() else repeated


def unmatched(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch rows whose key the target does not have.  The target is reduced to its keys; with a
    small batch they are looked up in it first, so that only matching ones are shuffled."""
    present = target.select(*keys)
    if fits_broadcast(batch.select(*keys)):
        present = present.join(F.broadcast(batch.select(*keys)), list(keys), "left_semi")
    return batch.join(present.distinct(), list(keys), "left_anti").select(*batch.columns)


def merge(
    target: DataFrame,
    batch: DataFrame,
    unique_key: Sequence[str] | str | None,
    *,
    update_columns: Sequence[str] | str | None = None,
    exclude_columns: Sequence[str] | str | None = None,
    predicates: Sequence[str] | str | None = None,
    aliases: tuple[str, str] = DEFAULT_ALIASES,
) -> DataFrame:
    """The target's rows after an upsert of the batch.

    * without a key nothing matches and every batch row is added;
    * a NULL key never matches;
    * ``predicates`` are further match conditions, written with the two aliases.  A target row
      failing one is not matched, so its batch row is added beside it;
    * two batch rows that match one target row are an error.
    """
    dest, src = aliases
    keys = resolve_columns(as_list(unique_key), target.columns, "unique_key")
    resolve_columns(keys, batch.columns, "unique_key")
    updates = update_list(target.columns, keys, update_columns, exclude_columns)
    batch = tables.by_target(batch, target)
    if not keys:
        return target.unionByName(batch)

    predicates = [predicates] if isinstance(predicates, str) else list(predicates or [])
    target, batch = target.alias(dest), batch.alias(src)
    on_target, on_batch, on_both = _split_predicates(target, batch, predicates, dest, src)

    # Rows a one-sided condition already rules out go straight to the result, unshuffled.
    pieces = []
    # NULL counts as not matched, as in any join condition.
    if on_target:
        test = _all([F.expr(t) for t in on_target])
        pieces.append(target.filter(~F.coalesce(test, F.lit(False))))
        target = target.filter(test).alias(dest)
    if on_batch:
        test = _all([F.expr(t) for t in on_batch])
        pieces.append(batch.filter(~F.coalesce(test, F.lit(False))))
        batch = batch.filter(test).alias(src)

    # A NULL key matches nothing, and neither may a repeated one, unless a two-sided condition chooses.
    known = _all([F.col(quote(k)).isNotNull() for k in keys])
    pieces.append(batch.filter(~known))
    batch = batch.filter(known).alias(src)
    repeated = repeated_keys(batch, keys)
    if repeated is not None and not on_both:
        if not repeated.join(target.select(*keys).distinct(), keys, "left_semi").isEmpty():
            raise ValueError(DUPLICATE_MATCH)
        pieces.append(batch.join(repeated, keys, "left_semi"))
        batch = batch.join(repeated, keys, "left_anti").alias(src)

    match = _all([F.col(f"{dest}.{quote(k)}") == F.col(f"{src}.{quote(k)}") for k in keys])
    match = match & _all([F.expr(t) for t in on_both])
    hit = F.col(f"{src}.{quote(keys[0])}").isNotNull()

    def after_update(column: str) -> Column:
        old = F.col(f"{dest}.{quote(column)}")
        if column in keys or column not in updates:
            return old.alias(column)
        new = F.col(f"{src}.{quote(column)}").cast(target.schema[column].dataType)
        return F.when(hit, new).otherwise(old).alias(column)

    small = F.broadcast(batch) if fits_broadcast(batch) else batch
    kept = target.join(small, match, "left").select(*[after_update(c) for c in target.columns])
    if on_both and repeated is not None:
        pieces += _added_by_content(target, batch, match, src)
    elif on_both:
        met = target.join(small, match, "inner").select(*[F.col(f"{src}.{quote(k)}").alias(k) for k in keys])
        pieces.append(batch.join(met.distinct(), keys, "left_anti"))
    else:
        pieces.append(unmatched(target, batch, keys))
    return reduce(DataFrame.unionByName, [p.select(*kept.columns) for p in pieces], kept)


def _added_by_content(target: DataFrame, batch: DataFrame, match: Column, src: str) -> list[DataFrame]:
    """Added rows where a condition chooses among batch rows of one key, so the key does not tell them.

    A batch row is known by its whole content: equal copies match alike.  The second piece is
    always empty; it fails the job when a target row is matched twice.
    """
    columns = target.columns
    small = F.broadcast(batch) if fits_broadcast(batch) else batch
    theirs = {c: F.col(f"{src}.{quote(c)}") for c in columns}
    renamed = {c: f"__source_{i}" for i, c in enumerate(columns)}
    matched = target.join(small, match, "inner").select(*[theirs[c].alias(renamed[c]) for c in columns]).distinct()
    same = _all([theirs[c].eqNullSafe(F.col(renamed[c])) for c in columns])
    added = batch.join(matched, same, "left_anti").select(*[theirs[c] for c in columns])
    pairs = target.withColumn("__row", F.monotonically_increasing_id()).join(small, match, "inner")
    twice = (
        pairs.groupBy("__row").agg(F.count(F.lit(1)).alias("__pairs"))
        .filter(~required(F.col("__pairs") == 1, DUPLICATE_MATCH))
        .select(*[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in columns])
    )
    return [added, twice]


def merge_into(
    ref: TableRef | str,
    batch: DataFrame,
    unique_key: Sequence[str] | str | None,
    **options: object,
) -> DataFrame:
    """Upsert a batch into a stored table; of a partitioned one only touched partitions are rewritten."""
    ref = TableRef.parse(ref)
    spark = batch.sparkSession
    target = tables.fresh(spark, ref)
    if not as_list(unique_key):
        return tables.append_rows(merge(target.limit(0), batch, None, **options), ref)
    # Names are checked before the batch is computed.
    keys = resolve_columns(as_list(unique_key), target.columns, "unique_key")
    resolve_columns(keys, batch.columns, "unique_key")
    updates = update_list(target.columns, keys, options.get("update_columns"), options.get("exclude_columns"))
    batch = tables.by_target(batch, target)
    parts = tables.partition_columns(spark, ref)
    with tables.staged(batch, ref) as stored:
        if not parts:
            return tables.rewrite(merge(target, stored, keys, **options), ref)
        return _merge_partitions(ref, target, stored, keys, parts, updates, options)


def _distinct_values(df: DataFrame, parts: Sequence[str]) -> set[tuple]:
    """Partition values, which the catalog lists on the driver as well."""
    return {tuple(r) for r in df.select(*parts).distinct().collect()}


def _merge_partitions(
    ref: TableRef, target: DataFrame, stored: DataFrame, keys: list[str],
    parts: list[str], updates: list[str], options: dict,
) -> DataFrame:
    spark = stored.sparkSession
    arriving = _distinct_values(stored, parts)
    leaving: set[tuple] = set()
    if not set(parts) <= set(keys):
        wanted = stored.select(*keys).distinct()
        wanted = F.broadcast(wanted) if fits_broadcast(stored.select(*keys)) else wanted
        leaving = _distinct_values(target.join(wanted, keys, "left_semi"), parts) - arriving
    touched = sorted(arriving | leaving, key=str)
    target = tables.in_partitions(target, parts, touched)
    result = merge(target, stored, keys, **options)
    emptied: set[tuple] = set()
    if leaving and set(parts) & set(updates):
        # Rows may move to another partition; one that loses its last row must be cleared.
        left_behind = tables.in_partitions(result, parts, sorted(leaving, key=str))
        emptied = leaving - _distinct_values(left_behind, parts)
    table = tables.overwrite_partitions(result, ref)
    if emptied:
        tables.empty_partitions(spark, ref, parts, sorted(emptied, key=str))
        table = spark.table(ref.sql)
    return table
