"""What happens when a batch and its table no longer have the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import tables
from tablewright.naming import TableRef, as_list, quote, resolve_columns

POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


class SchemaChanged(ValueError):
    """The batch's columns differ and the policy does not allow it."""


def differences(target: DataFrame, batch: DataFrame) -> tuple[list[T.StructField], list[str], list[str]]:
    """New columns, columns gone, and columns whose type changed."""
    ours = {f.name.lower(): f for f in target.schema}
    theirs = {f.name.lower(): f for f in batch.schema}
    added = [f for n, f in theirs.items() if n not in ours]
    removed = [f.name for n, f in ours.items() if n not in theirs]
    retyped = [f.name for n, f in ours.items() if n in theirs and theirs[n].dataType != f.dataType]
    return added, removed, retyped


def evolve(
    target: DataFrame, batch: DataFrame, policy: str = "ignore", allow_drop: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Target and batch brought to one column list, as the policy says.

    * ``ignore``: the target's columns decide;
    * ``fail``: any difference is an error;
    * ``append_new_columns``: new columns are added, NULL for old rows; columns gone from the batch stay;
    * ``sync_all_columns``: the batch's columns decide; removing one needs ``allow_drop``.
    """
    if policy not in POLICIES:
        raise ValueError(f"on_schema_change must be one of {', '.join(POLICIES)}, got {policy!r}")
    added, removed, retyped = differences(target, batch)
    if policy == "ignore" or not (added or removed or retyped):
        return target, batch
    if policy == "fail":
        raise SchemaChanged(
            f"columns differ: new {[f.name for f in added]}, gone {removed}, type changed {retyped}")
    if policy == "sync_all_columns" and removed and not allow_drop:
        raise SchemaChanged(f"columns {removed} would be dropped; pass allow_drop=True to agree")
    if policy == "sync_all_columns":
        target = target.drop(*removed)
        for name in retyped:
            kind = next(f.dataType for f in batch.schema if f.name.lower() == name.lower())
            target = target.withColumn(name, F.col(quote(name)).cast(kind))
    else:
        for name in removed:
            batch = batch.withColumn(name, F.lit(None).cast(target.schema[name].dataType))
    for f in added:
        target = target.withColumn(f.name, F.lit(None).cast(f.dataType))
    return target, batch


# Whole numbers by width; Spark reads the narrower ones of a parquet file as the wider.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether files with the old type can be read as the new one, every value kept."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return _WHOLE.index(type(old)) <= _WHOLE.index(type(new))
    return isinstance(new, T.DoubleType) and isinstance(old, (T.FloatType, *_WHOLE[:3]))


def _by_catalog(ref: TableRef, before: DataFrame, after: DataFrame) -> bool:
    """Whether the stored files can stay as they are.

    They can where columns only go, come under names the files do not hold, or get a wider type, in an external
    parquet table, and neither partitions nor buckets depend on what changes.
    """
    spark = before.sparkSession
    details = tables.describe(spark, ref)[1]
    if details.get("Provider", "").lower() != "parquet" or details.get("Type") != "EXTERNAL":
        return False
    if any(set(f.metadata) - {"comment"} for f in before.schema):  # char and varchar lengths
        return False
    had, old = tables.storage_of(spark, ref), {f.name: f.dataType for f in before.schema}
    new = {f.name: f.dataType for f in after.schema}
    fixed = [*as_list(had.partition_by), *(as_list(had.clustered_by) if had.buckets else [])]
    if any(new.get(c) != old[c] for c in fixed):
        return False
    if {c.lower() for c in new if c not in old} & tables.still_stored(spark, ref):
        return False
    return all(new[c] == old[c] or widens(old[c], new[c]) for c in new if c in old)


def change_columns(ref: TableRef, after: DataFrame) -> DataFrame:
    """Bring a stored table to the columns of ``after``, which reads it.

    Dropping, adding and widening are entries of the catalog, the files stay: files without a column read as NULL,
    files of a narrower type are read as the wider one.  The table is rewritten where that would not give the
    rows of ``after``: for other changes of type, and for a new column under the name of one that was dropped since
    the files were written, whose old values would come back.  (Parquet field ids tell the two apart when rows are
    read, but filters are pushed to the files by name and lose rows there.)
    """
    spark = after.sparkSession
    before = tables.fresh(spark, ref)
    if [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in before.schema]:
        return before
    if not _by_catalog(ref, before, after):
        return tables.rewrite(after, ref)
    about = {f.name: f.metadata for f in before.schema}
    schema = T.StructType([T.StructField(f.name, f.dataType, True, about.get(f.name)) for f in after.schema])
    tables.redeclare(spark, ref, schema, [c for c in before.columns if c not in after.columns])
    return spark.table(ref.sql)


def apply_schema_change(
    ref: TableRef, batch: DataFrame, policy: str = "ignore", allow_drop: bool = False
) -> DataFrame:
    """Bring a stored table to the evolved columns and return the batch that fits it.

    Only what ``change_columns`` cannot say in the catalog rewrites the table.
    """
    spark = batch.sparkSession
    before = tables.fresh(spark, ref)
    after, batch = evolve(before, batch, policy, allow_drop)
    new = [f for f in after.schema if f.name not in before.columns]
    kept = [(f.name, f.dataType) for f in after.schema if f.name in before.columns]
    same = kept == [(f.name, f.dataType) for f in before.schema]
    if not same or {f.name.lower() for f in new} & tables.still_stored(spark, ref):
        change_columns(ref, after)
    elif new:
        listed = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {ref.sql} ADD COLUMNS ({listed})")
        spark.catalog.refreshTable(ref.sql)
    return batch


def widen_column(spark, ref: TableRef | str, column: str, new_type: str) -> DataFrame:
    """Change a column's type: a wider one in the catalog alone, any other by rewriting the table.

    A value that does not fit fails the job.
    """
    ref = TableRef.parse(ref)
    df = tables.fresh(spark, ref)
    (name,) = resolve_columns([column], df.columns, "widen_column")
    return change_columns(ref, df.withColumn(name, F.col(quote(name)).cast(new_type)))
