"""Incremental models: the first run builds the table, later runs apply a batch to it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.naming import TableRef, as_list, quote, resolve_columns
from tablewright.operators.merge import merge_into
from tablewright.operators.schema_change import apply_schema_change
from tablewright.sizes import fits_broadcast
from tablewright.tables import Storage
from tablewright.workspace import scratch_path

STRATEGIES = ("append", "merge", "insert_overwrite", "microbatch")


def validate_incremental(strategy: str | None, fmt: str, partition_by: Sequence[str] | str | None = None) -> str:
    """Refuse a bad combination before any job runs."""
    strategy = strategy or "append"
    if fmt not in tables.FORMATS:
        raise ValueError(f"invalid file format {fmt!r}; expected one of {', '.join(tables.FORMATS)}")
    if strategy not in STRATEGIES:
        raise ValueError(f"invalid incremental strategy {strategy!r}; expected one of {', '.join(STRATEGIES)}")
    if fmt == "delta":
        raise ValueError("delta tables need Delta Lake's own commits; use parquet")
    if fmt == "csv" and strategy != "append":
        raise ValueError(f"strategy {strategy!r} needs a columnar table, not {fmt!r}")
    if strategy == "microbatch" and not as_list(partition_by):
        raise ValueError("strategy 'microbatch' needs partition_by")
    return strategy


def append(ref: TableRef | str, batch: DataFrame) -> DataFrame:
    """Add the batch's rows, copies included; columns the table does not have are left out."""
    return tables.append_rows(batch, TableRef.parse(ref))


def insert_overwrite(ref: TableRef | str, batch: DataFrame) -> DataFrame:
    """Replace the table's rows; of a partitioned table only the partitions in the batch."""
    ref = TableRef.parse(ref)
    spark = batch.sparkSession
    if tables.partition_columns(spark, ref):
        return tables.overwrite_partitions(batch, ref)
    return tables.rewrite(tables.by_target(batch, tables.fresh(spark, ref)), ref)


def without_values_of(target: DataFrame, batch: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Target rows whose values in ``columns`` do not occur in the batch; NULL equals NULL here."""
    columns = resolve_columns(as_list(columns), target.columns, "partition_by")
    resolve_columns(columns, batch.columns, "partition_by")
    values = batch.select(*[F.col(quote(c)).alias(f"__v{i}") for i, c in enumerate(columns)]).distinct()
    if fits_broadcast(batch.select(*columns)):
        values = F.broadcast(values)
    same = reduce(lambda a, b: a & b,
                  [F.col(quote(c)).eqNullSafe(F.col(f"__v{i}")) for i, c in enumerate(columns)])
    return target.join(values, same, "left_anti")


def replaced(target: DataFrame, batch: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Delete the target rows with the batch's partition values, then add the batch."""
    return without_values_of(target, batch, columns).unionByName(tables.by_target(batch, target))


def replace_partitions(ref: TableRef | str, batch: DataFrame, partition_by: Sequence[str] | str) -> DataFrame:
    """``replaced`` on a stored table: in place where it is partitioned that way, else as a rewrite."""
    ref = TableRef.parse(ref)
    spark = batch.sparkSession
    wanted = as_list(partition_by)
    if not wanted:
        raise ValueError("replace_partitions needs partition_by")
    target = tables.fresh(spark, ref)
    wanted = resolve_columns(wanted, target.columns, "partition_by")
    if set(tables.partition_columns(spark, ref)) == set(wanted):
        return tables.overwrite_partitions(batch, ref)
    with tables.staged(tables.by_target(batch, target), ref) as stored:
        parts = tables.partition_columns(spark, ref)
        if not parts:
            return tables.rewrite(replaced(target, stored, wanted), ref)
        # Partitioned otherwise: deleted rows may empty a partition, so the table is built anew.
        return tables.write_table(replaced(target, stored, wanted), ref, tables.storage_of(spark, ref))


def slices(begin: datetime, end: datetime, batch_size: str) -> list[tuple[datetime, datetime]]:
    """The half-open time slices that cover ``[begin, end]``, aligned to the batch size."""
    steps = {"hour": timedelta(hours=1), "day": timedelta(days=1)}

    def floor(t: datetime) -> datetime:
        t = t.replace(minute=0, second=0, microsecond=0)
        if batch_size != "hour":
            t = t.replace(hour=0)
        if batch_size in ("month", "year"):
            t = t.replace(day=1)
        return t.replace(month=1) if batch_size == "year" else t

    def following(t: datetime) -> datetime:
        if batch_size in steps:
            return t + steps[batch_size]
        if batch_size == "month":
            return t.replace(year=t.year + t.month // 12, month=t.month % 12 + 1)
        return t.replace(year=t.year + 1)

    if batch_size not in ("hour", "day", "month", "year"):
        raise ValueError(f"batch_size must be hour, day, month or year, got {batch_size!r}")
    result, lo = [], floor(begin)
    while lo < end:
        result.append((lo, following(lo)))
        lo = following(lo)
    return result


def microbatch(
    ref: TableRef | str,
    source: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    *,
    event_time: str,
    batch_size: str,
    begin: datetime,
    end: datetime,
    partition_by: Sequence[str] | str,
    rowwise: bool = False,
    storage: Storage = Storage(),
    whole_partitions: bool = False,
) -> DataFrame:
    """Rebuild the slices of ``[begin, end]`` from the source rows whose event time falls in them.

    The model is run once per slice.  One that works row by row, so that slices do not
    matter to it, can be run over all of them at once with ``rowwise=True``.  Several slices are
    gathered beside the table and put in place together, so a partition may hold more than one.
    Rows outside the slices are not picked up; running again changes nothing.

    Exactly the table's rows with an event time in the slices are replaced, however coarse the partitions are: the
    others stay, those without an event time too.  For that the model must keep the event time.  One that does not (a
    sum per day, say) needs ``whole_partitions=True``, which says that the partitions are of the grain of the
    slices; then those with new rows are replaced whole.
    """
    ref = TableRef.parse(ref)
    spark = source.sparkSession
    validate_incremental("microbatch", storage.fmt, partition_by)
    parts = slices(begin, end, batch_size)
    if rowwise and parts:
        parts = [(parts[0][0], parts[-1][1])]
    kind = source.schema[event_time].dataType
    at = F.col(quote(event_time))
    batches = (model(source.filter((at >= F.lit(str(lo)).cast(kind)) & (at < F.lit(str(hi)).cast(kind)))) for lo, hi in parts)
    if not parts:
        return spark.table(ref.sql)
    if len(parts) == 1:
        batch = next(batches)
    else:
        gathered = scratch_path(spark, "slices")
        for batch in batches:
            schema = batch.schema
            batch.write.mode("append").parquet(gathered)
        batch = spark.read.schema(schema).parquet(gathered)
    if tables.table_kind(spark, ref) != "table":
        tables.write_table(batch, ref, Storage(**{**storage.__dict__, "partition_by": as_list(partition_by)}))
    elif whole_partitions:
        replace_partitions(ref, batch, partition_by)
    else:
        replace_range(ref, batch, event_time, parts[0][0], parts[-1][1])
    return spark.table(ref.sql)


def replace_range(ref: TableRef | str, batch: DataFrame, event_time: str, begin: datetime, end: datetime) -> DataFrame:
    """Replace the table's rows whose event time lies in ``[begin, end)`` by the batch, and no others.

    Only partitions that hold such rows or receive new ones are rewritten; one that loses its last row is dropped.
    """
    ref = TableRef.parse(ref)
    spark = batch.sparkSession
    target = tables.fresh(spark, ref)
    if event_time.lower() not in [c.lower() for c in target.columns]:
        raise ValueError(f"{ref.sql} has no column {event_time!r}, so rows outside the slices cannot be told from those inside")
    (name,) = resolve_columns([event_time], target.columns, "event_time")
    kind, at = target.schema[name].dataType, F.col(quote(name))
    inside = F.coalesce((at >= F.lit(str(begin)).cast(kind)) & (at < F.lit(str(end)).cast(kind)), F.lit(False))
    with tables.staged(tables.by_target(batch, target), ref) as stored:
        parts = tables.partition_columns(spark, ref)
        if not parts:
            return tables.rewrite(target.filter(~inside).unionByName(stored), ref)
        values = lambda df: {tuple(r) for r in df.select(*parts).distinct().collect()}  # noqa: E731  (the catalog lists them, too)
        arriving, holding = values(stored), values(target.filter(inside))
        touched = sorted(arriving | holding, key=str)
        rest = tables.in_partitions(target, parts, touched).filter(~inside)
        emptied = holding - arriving - values(tables.in_partitions(rest, parts, sorted(holding - arriving, key=str)))
        tables.overwrite_partitions(rest.unionByName(stored), ref)
        if emptied:
            tables.empty_partitions(spark, ref, parts, sorted(emptied, key=str))
        return tables.fresh(spark, ref)


def newer_than(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows above the highest value the target holds; all rows while it holds none.

    The bound is read first (one value), so that it reaches the source's scan as a literal
    and skips files and row groups.  It travels as text, which every ordered type casts back from.
    """
    (bound,) = target.agg(F.max(F.col(quote(column))).cast("string")).first()
    if bound is None:
        return source
    return source.filter(F.col(quote(column)) > F.lit(bound).cast(source.schema[column].dataType))


def high_watermark(spark: SparkSession, source: DataFrame, ref: TableRef | str, column: str) -> DataFrame:
    """``newer_than`` for a stored table; without one yet, the whole source."""
    ref = TableRef.parse(ref)
    if tables.table_kind(spark, ref) is None:
        return source
    return newer_than(source, tables.fresh(spark, ref), column)


def build_incremental(
    spark: SparkSession,
    ref: TableRef | str,
    model: Callable[[bool], DataFrame],
    *,
    strategy: str | None = None,
    unique_key: Sequence[str] | str | None = None,
    storage: Storage = Storage(),
    on_schema_change: str = "ignore",
    allow_drop: bool = False,
    full_refresh: bool = False,
    update_columns: Sequence[str] | str | None = None,
    exclude_columns: Sequence[str] | str | None = None,
    predicates: Sequence[str] | str | None = None,
    pre: Sequence[Callable[[], object]] = (),
    post: Sequence[Callable[[], object]] = (),
) -> DataFrame:
    """Run an incremental model.  ``model(is_incremental)`` returns the rows of this run.

    The table is built from ``model(False)`` on the first run, on a full refresh, or when a
    view holds the name; otherwise ``model(True)`` is applied by the strategy.
    """
    ref = TableRef.parse(ref)
    strategy = validate_incremental(strategy, storage.fmt, storage.partition_by)
    if as_list(update_columns) and as_list(exclude_columns):
        raise ValueError("give update_columns or exclude_columns, not both")
    for hook in pre:
        hook()
    if full_refresh or tables.table_kind(spark, ref) != "table":
        tables.write_table(model(False), ref, storage)
    else:
        batch = apply_schema_change(ref, model(True), on_schema_change, allow_drop)
        if strategy == "append":
            append(ref, batch)
        elif strategy == "insert_overwrite":
            insert_overwrite(ref, batch)
        elif strategy == "microbatch":
            replace_partitions(ref, batch, storage.partition_by)
        else:
            merge_into(ref, batch, unique_key, update_columns=update_columns,
                       exclude_columns=exclude_columns, predicates=predicates)
    for hook in post:
        hook()
    return spark.table(ref.sql)
