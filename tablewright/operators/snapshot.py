"""Type-2 history: every version of a row with the time it was valid.

A run compares the source with the open versions only, in one full outer join on the key.  Both
sides have one row per key, so it cannot be skewed; each side is shuffled once, and a history
bucketed by its key not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.guards import required
from tablewright.naming import TableRef, as_list, quote, resolve_columns
from tablewright.operators.comparing import comparable, differ
from tablewright.tables import Storage


@dataclass(frozen=True)
class SnapshotColumns:
    """Names of the four bookkeeping columns."""

    scd_id: str = "scd_id"
    updated_at: str = "scd_updated_at"
    valid_from: str = "scd_valid_from"
    valid_to: str = "scd_valid_to"

    @classmethod
    def with_prefix(cls, prefix: str) -> "SnapshotColumns":
        return cls(f"{prefix}scd_id", f"{prefix}updated_at", f"{prefix}valid_from", f"{prefix}valid_to")

    def names(self) -> list[str]:
        return [self.scd_id, self.updated_at, self.valid_from, self.valid_to]


@dataclass(frozen=True)
class SnapshotConfig:
    """How versions are told apart.

    ``strategy="timestamp"`` opens a version when ``updated_at`` advances; ``"check"`` when one of
    ``check_cols`` (a list, or ``"all"``) differs.  ``hard_deletes="invalidate"`` closes rows that
    left the source.  ``valid_to_current`` is a SQL expression open versions carry instead of NULL.
    """

    unique_key: Sequence[str] | str
    strategy: str
    updated_at: str | None = None
    check_cols: Sequence[str] | str | None = None
    hard_deletes: str = "ignore"
    valid_to_current: str | None = None
    columns: SnapshotColumns = SnapshotColumns()

    def __post_init__(self) -> None:
        if not as_list(self.unique_key):
            raise ValueError("a snapshot needs a unique_key")
        if self.strategy not in ("timestamp", "check"):
            raise ValueError(f"unknown snapshot strategy {self.strategy!r}; use timestamp or check")
        if self.strategy == "timestamp" and not self.updated_at:
            raise ValueError("strategy 'timestamp' needs updated_at")
        if self.strategy == "check" and not as_list(self.check_cols):
            raise ValueError("strategy 'check' needs check_cols")
        if self.hard_deletes not in ("ignore", "invalidate"):
            raise ValueError("hard_deletes must be ignore or invalidate")


def scd_id(*parts: Column) -> Column:
    """md5 over the text of the parts, NULL as empty, with a bar between them."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def as_time(now: datetime | str) -> Column:
    """The run's time; passed in, so that a run can be repeated."""
    return F.lit(str(now)).cast("timestamp_ntz")


def _checked_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source, failing the job on a NULL key."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(quote(k)).isNotNull()
    return source.filter(required(present, "snapshot: NULL in unique_key"))


def _no_repeated_key(source: DataFrame, keys: list[str], like: DataFrame) -> DataFrame:
    """No rows; the job fails when a key occurs twice in the source (counted before the shuffle)."""
    once = required(F.col("__copies") == 1, "snapshot: unique_key is not unique in the source")
    return (
        source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies")).filter(~once)
        .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema])
    )


def _open_mark(config: SnapshotConfig) -> Column:
    sentinel = F.expr(config.valid_to_current) if config.valid_to_current else F.lit(None)
    return sentinel.cast("timestamp_ntz")


def _versions(source: DataFrame, config: SnapshotConfig, keys: list[str], now: datetime | str) -> DataFrame:
    """Source rows dressed as open versions."""
    c = config.columns
    stamp = F.col(quote(config.updated_at)).cast("timestamp_ntz") if config.strategy == "timestamp" else as_time(now)
    return source.select(
        "*",
        scd_id(*[F.col(quote(k)) for k in keys], stamp).alias(c.scd_id),
        stamp.alias(c.updated_at),
        stamp.alias(c.valid_from),
        _open_mark(config).alias(c.valid_to),
    )


def snapshot_init(source: DataFrame, config: SnapshotConfig, now: datetime | str) -> DataFrame:
    """First run: every source row is an open version."""
    keys = resolve_columns(as_list(config.unique_key), source.columns, "unique_key")
    first = _versions(_checked_source(source, keys), config, keys, now)
    return first.unionByName(_no_repeated_key(source, keys, first))


def is_open(config: SnapshotConfig) -> Column:
    valid_to = F.col(quote(config.columns.valid_to))
    test = valid_to.isNull()
    if config.valid_to_current:
        test = test | valid_to.eqNullSafe(_open_mark(config))
    return test


def validate_target(history: DataFrame, config: SnapshotConfig) -> None:
    missing = [n for n in config.columns.names() if n not in history.columns]
    if missing:
        raise ValueError(f"not a snapshot table, missing {', '.join(missing)}")


def _watched(source: DataFrame, history: DataFrame, config: SnapshotConfig, keys: list[str]) -> list[str]:
    if as_list(config.check_cols) != ["all"] or "all" in source.columns:
        return resolve_columns(as_list(config.check_cols), source.columns, "check_cols")
    return [n for n in source.columns if n not in keys]


@dataclass(frozen=True)
class SnapshotStep:
    """The outcome of one run, in two disjoint parts of the same columns."""

    closed_before: DataFrame  # versions closed by earlier runs, untouched
    moved: DataFrame          # versions open before this run, some now closed, and new versions

    def all_rows(self) -> DataFrame:
        return self.closed_before.unionByName(self.moved)


def snapshot_step(
    history: DataFrame, source: DataFrame, config: SnapshotConfig, now: datetime | str
) -> SnapshotStep:
    """Compare the source with the open versions.

    Columns new in the source are added, NULL in old versions; columns gone from it stay and are
    NULL in new versions.  Running again on the same source adds nothing.  A key that was closed
    as deleted and comes back opens a new version.  A key that is NULL or repeated in the source fails
    the job; that is seen in the partitioning and order the join needs anyway.
    """
    c = config.columns
    validate_target(history, config)
    # Names are the same whatever their case; the history's spelling counts.
    spelling = {n.lower(): n for n in history.columns}
    source = source.select(*[F.col(quote(n)).alias(spelling.get(n.lower(), n)) for n in source.columns])
    keys = resolve_columns(as_list(config.unique_key), source.columns, "unique_key")
    resolve_columns(keys, history.columns, "unique_key")
    have = {n.lower() for n in history.columns}
    for f in [f for f in source.schema if f.name.lower() not in have]:
        history = history.withColumn(f.name, F.lit(None).cast(f.dataType))

    first = _versions(_checked_source(source, keys), config, keys, now)
    current = history.filter(is_open(config))
    # Types as of a union of both sides.
    kinds = {f.name: f.dataType for f in current.unionByName(first, allowMissingColumns=True).schema}

    if config.strategy == "timestamp":
        newer = F.col(f"old.{quote(c.valid_from)}") < F.col(f"new.{quote(c.valid_from)}")
    else:
        watched = {n: source.schema[n].dataType for n in _watched(source, history, config, keys)}
        newer = differ([(comparable(F.col(f"old.{quote(n)}").cast(kind), kind),
                         comparable(F.col(f"new.{quote(n)}"), kind)) for n, kind in watched.items()])
    nth = F.row_number().over(W.partitionBy(*[quote(k) for k in keys]).orderBy(*[quote(k) for k in keys]))
    new = first.withColumn("__nth", nth).filter(
        required(F.col("__nth") == 1, "snapshot: unique_key is not unique in the source")).alias("new")
    old = current.withColumn("__old", F.lit(True)).alias("old")
    in_old, in_new = F.col("old.__old").isNotNull(), F.col("new.__nth").isNotNull()
    changed = in_old & in_new & F.coalesce(newer, F.lit(False))

    # An open version is closed when the row changed or left the source.
    until = F.when(changed, F.col(f"new.{quote(c.valid_from)}"))
    if config.hard_deletes == "invalidate":
        until = F.when(~in_new, as_time(now)).otherwise(until)
    until = F.coalesce(until, F.col(f"old.{quote(c.valid_to)}"))
    was = F.struct(*[(until if n == c.valid_to else F.col(f"old.{quote(n)}")).cast(kinds[n]).alias(n)
                     for n in history.columns])
    # A version is opened for a key that was not open before, and for a changed row.
    made = F.struct(*[(F.col(f"new.{quote(n)}") if n in first.columns else F.lit(None)).cast(kinds[n]).alias(n)
                      for n in history.columns])
    same_key = [F.col(f"old.{quote(k)}") == F.col(f"new.{quote(k)}") for k in keys]
    moved = (
        old.join(new, same_key, "full")
        .select(F.explode(F.array(F.when(in_old, was), F.when(~in_old | changed, made))).alias("__row"))
        .filter(F.col("__row").isNotNull()).select("__row.*")
    )
    return SnapshotStep(history.filter(~is_open(config)), moved)


def snapshot_next(history: DataFrame, source: DataFrame, config: SnapshotConfig, now: datetime | str) -> DataFrame:
    """The whole history after another run."""
    return snapshot_step(history, source, config, now).all_rows()


CLOSED = "closed_in"
_PERIOD_PROPERTY = "tablewright.closing_period"


def snapshot(
    source: DataFrame,
    ref: TableRef | str,
    config: SnapshotConfig,
    now: datetime | str,
    storage: Storage = Storage(),
    closing_period: str | None = None,
    stage: bool = False,
) -> DataFrame:
    """Run a snapshot into a stored table.

    The source is read once.  ``stage`` stores it beside the table first, which shields a costly source from
    being computed again where executors are lost.

    ``closing_period`` (``day``, ``month`` or ``year``, fixed by the first run) partitions the table by
    the period in which a version was closed: a column ``closed_in`` with its first day, NULL while
    open.  A run then rewrites the open versions and the periods in which it closes versions, and
    never reads or writes the rest of the history.
    """
    ref = TableRef.parse(ref)
    spark = source.sparkSession
    if storage.fmt not in ("parquet", "delta"):
        raise ValueError(f"a snapshot cannot be stored as {storage.fmt!r}")
    if closing_period not in (None, "day", "month", "year"):
        raise ValueError("closing_period must be day, month or year")
    kind = tables.table_kind(spark, ref)
    if kind is None:
        first = snapshot_init(source, config, now)
        if closing_period:
            first = first.withColumn(CLOSED, _closed_in(config, closing_period))
            storage = replace(storage, partition_by=[CLOSED],
                              properties={**storage.properties, _PERIOD_PROPERTY: closing_period})
        return tables.write_table(first, ref, storage)
    tables.require_table(spark, ref)
    history = tables.fresh(spark, ref)
    validate_target(history, config)
    layout = tables.storage_of(spark, ref)
    with tables.staged(source, ref) if stage else nullcontext(source) as stored:
        if layout.buckets and as_list(layout.clustered_by) == resolve_columns(as_list(config.unique_key), history.columns, "unique_key"):
            # Dealt as the table's buckets are, so that the history stays where it is.
            stored = stored.repartition(layout.buckets, *[quote(k) for k in as_list(config.unique_key)])
        period = tables.properties(spark, ref).get(_PERIOD_PROPERTY)
        if period is None:
            return tables.rewrite(snapshot_next(history, stored, config, now), ref)
        return _snapshot_periods(ref, history, stored, config, now, _closed_in(config, period))


def _closed_in(config: SnapshotConfig, period: str) -> Column:
    valid_to = F.col(quote(config.columns.valid_to))
    return F.when(~is_open(config), F.date_trunc(period, valid_to).cast("date"))


def _snapshot_periods(ref: TableRef, history: DataFrame, source: DataFrame, config: SnapshotConfig,
                      now: datetime | str, closed_in: Column) -> DataFrame:
    spark = source.sparkSession
    new_columns = [f for f in source.schema if f.name.lower() not in {n.lower() for n in history.columns}]
    if new_columns:
        listed = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new_columns)
        spark.sql(f"ALTER TABLE {ref.sql} ADD COLUMNS ({listed})")
        history = spark.table(ref.sql)
    # The open versions alone decide what changes.
    current = history.filter(F.col(CLOSED).isNull()).drop(CLOSED)
    step = snapshot_step(current, source, config, now)
    with tables.staged(step.moved.withColumn(CLOSED, closed_in), ref) as moved:
        # Partition values, which the catalog lists on the driver as well.
        found = {r[0] for r in moved.select(CLOSED).distinct().collect()}
        periods = sorted([(p,) for p in found if p is not None])
        result = moved
        if periods:
            beside = history.filter(F.col(CLOSED).isNotNull())
            beside = tables.in_partitions(beside, [CLOSED], periods)
            result = moved.unionByName(beside)
        table = tables.overwrite_partitions(result, ref)
    if found and None not in found:
        tables.empty_partitions(spark, ref, [CLOSED], [(None,)])
        table = spark.table(ref.sql)
    return table
