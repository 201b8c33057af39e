"""Tables whose writers leave a log of row changes.

A logged write computes, in one pass, the rows of the new version and the changes that lead to it; both are written by
the same job, into two folders of the version's directory.  The catalog is pointed at the first; the second is that
version's entry in the log.  The number of a version is part of its directory's name, so rows, log and number change
in one catalog update, and a job that fails leaves a directory that nobody reads.

Changes since a version are read from the log alone.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import tables
from tablewright.naming import TableRef, as_list, quote, resolve_columns, sql_text
from tablewright.operators.comparing import comparable, differ
from tablewright.operators.merge import repeated_keys, unmatched, update_list
from tablewright.operators.views import CHANGE_TYPE
from tablewright.sizes import fits_broadcast

KEY_PROPERTY = "tablewright.log_key"
FIRST_PROPERTY = "tablewright.log_first"  # the oldest version that the log starts from
ENTRY_PROPERTY = "tablewright.log_entry."  # and a number: where that version lies
VERSION = "_version"
_KIND, _VERSION = "__kind", "__version"
_PLACE = re.compile(r"^(.*/__version=(\d+)_[0-9a-f]{12})/__kind=rows/?$")


def _row(kind: str, columns: Mapping[str, Column], change: Column) -> Column:
    return F.struct(F.lit(kind).alias(_KIND), *[c.alias(name) for name, c in columns.items()], change.cast("string").alias(CHANGE_TYPE))


def _images(before: Mapping[str, Column] | None, after: Mapping[str, Column] | None, changed: Column) -> list[Column]:
    """The rows that one row (or none) becomes: the one of the new version, and those of the log if it has ``changed``."""
    both = before is not None and after is not None
    found = []
    if after is not None:
        found.append(_row("rows", after, F.lit(None)))
    if before is not None:
        found.append(F.when(changed, _row("changes", before, F.lit("update_preimage" if both else "delete"))))
    if after is not None:
        found.append(F.when(changed, _row("changes", after, F.lit("update_postimage" if both else "insert"))))
    return found


def _out(df: DataFrame, images: Sequence[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*images)).alias("__row")).filter(F.col("__row").isNotNull()).select("__row.*")


def _root(spark: SparkSession, ref: TableRef) -> str:
    return spark.catalog.getDatabase(ref.namespace_sql).locationUri.rstrip("/") + f"/{ref.name}__log"


def version(spark: SparkSession, ref: TableRef | str) -> int:
    """The number of a logged table's version."""
    ref = TableRef.parse(ref)
    found = _PLACE.search(tables.location(spark, ref)) if tables.table_kind(spark, ref) == "table" else None
    if found is None:
        raise ValueError(f"{ref.sql} has no change log")
    return int(found[2])


def _write(rows: DataFrame, ref: TableRef, number: int) -> str:
    """Write version and log entry; the path of the version's rows."""
    spark = rows.sparkSession
    path = f"{_root(spark, ref)}/{_VERSION}={number:09d}_{uuid.uuid4().hex[:12]}"
    rows.write.partitionBy(_KIND).parquet(path)
    # The folder must be there for a version without rows, too.
    spark.createDataFrame([], rows.drop(_KIND).schema).write.mode("append").parquet(f"{path}/{_KIND}=rows")
    return f"{path}/{_KIND}=rows"


def create_logged(df: DataFrame, ref: TableRef | str, key: Sequence[str] | str, *, properties: Mapping[str, str] | None = None,
                  comment: str | None = None) -> DataFrame:
    """A table with a log, from its first rows; it replaces what has its name.  The log begins after them."""
    ref = TableRef.parse(ref)
    spark = df.sparkSession
    keys = resolve_columns(as_list(key), df.columns, "key")
    if not keys:
        raise ValueError("a logged table needs a key")
    if {c.lower() for c in df.columns} & {CHANGE_TYPE, VERSION, _KIND, _VERSION}:
        raise ValueError("the table has a column that the log needs")
    path = _write(_out(df, [_row("rows", {c: F.col(quote(c)) for c in df.columns}, F.lit(None))]), ref, 0)
    tables.drop(spark, ref)
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE {ref.sql} ({columns}) USING parquet LOCATION {sql_text(path)}")
    tables.set_properties(spark, ref, {**(properties or {}), KEY_PROPERTY: json.dumps(keys), FIRST_PROPERTY: "0"})
    if comment:
        spark.sql(f"COMMENT ON TABLE {ref.sql} IS {sql_text(comment)}")
    return tables.fresh(spark, ref)


def _commit(rows: DataFrame, ref: TableRef) -> DataFrame:
    """Write the next version with its log entry and point the catalog at it."""
    spark = rows.sparkSession
    before, place = version(spark, ref), tables.location(spark, ref)
    path = _write(rows, ref, before + 1)
    if tables.location(spark, ref) != place:
        raise RuntimeError(f"{ref.sql} was changed by another writer; nothing was done")
    # Where the entry of the version before lies is noted first, and does no harm if this one is never reached.
    tables.set_properties(spark, ref, {f"{ENTRY_PROPERTY}{before}": place})
    spark.sql(f"ALTER TABLE {ref.sql} SET LOCATION {sql_text(path)}")
    return tables.fresh(spark, ref)


def _keys(spark: SparkSession, ref: TableRef) -> list[str]:
    version(spark, ref)
    return json.loads(tables.properties(spark, ref)[KEY_PROPERTY])


def merge_logged(ref: TableRef | str, batch: DataFrame, *, update_columns: Sequence[str] | str | None = None,
                 exclude_columns: Sequence[str] | str | None = None) -> DataFrame:
    """Upsert a batch by the table's key.  A key that the batch repeats is an error; one that is NULL is added."""
    ref = TableRef.parse(ref)
    spark = batch.sparkSession
    keys, target = _keys(spark, ref), tables.fresh(spark, ref)
    resolve_columns(keys, batch.columns, "key")
    updates = update_list(target.columns, keys, update_columns, exclude_columns)
    with tables.staged(tables.by_target(batch, target), ref) as stored:
        has_key = reduce(lambda x, y: x & y, [F.col(quote(k)).isNotNull() for k in keys])
        known = stored.filter(has_key)
        if repeated_keys(known, keys) is not None:
            raise ValueError("the batch repeats a key")
        small = F.broadcast(known) if fits_broadcast(known) else known
        same = [F.col(f"t.{quote(k)}") == F.col(f"b.{quote(k)}") for k in keys]
        hit = F.col(f"b.{quote(keys[0])}").isNotNull()
        old = {c: F.col(f"t.{quote(c)}") for c in target.columns}
        new = {c: F.when(hit, F.col(f"b.{quote(c)}")).otherwise(old[c]) if c in updates and c not in keys else old[c] for c in target.columns}
        kinds = {f.name: f.dataType for f in target.schema}
        changed = hit & differ([(comparable(old[c], kinds[c]), comparable(new[c], kinds[c])) for c in target.columns if c not in keys])
        kept = _out(target.alias("t").join(small.alias("b"), same, "left"), _images(old, new, changed))
        plain = {c: F.col(quote(c)) for c in target.columns}
        added = unmatched(target, known, keys).unionByName(stored.filter(~has_key))
        return _commit(kept.unionByName(_out(added, _images(None, plain, F.lit(True)))), ref)


def update_logged(spark: SparkSession, ref: TableRef | str, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns of the rows that meet a condition, in one scan.  The key cannot be set."""
    ref = TableRef.parse(ref)
    keys, df = _keys(spark, ref), tables.fresh(spark, ref)
    set_ = dict(zip(resolve_columns(list(values), df.columns, "update"), values.values()))
    if set(set_) & set(keys):
        raise ValueError("the key of a logged table cannot be updated")
    hit = F.coalesce(condition, F.lit(False))
    old = {f.name: F.col(quote(f.name)) for f in df.schema}
    new = {f.name: F.when(hit, set_[f.name].cast(f.dataType)).otherwise(old[f.name]) if f.name in set_ else old[f.name] for f in df.schema}
    kinds = {f.name: f.dataType for f in df.schema}
    changed = hit & differ([(comparable(old[c], kinds[c]), comparable(new[c], kinds[c])) for c in set_])
    return _commit(_out(df, _images(old, new, changed)), ref)


def delete_logged(spark: SparkSession, ref: TableRef | str, condition: Column) -> DataFrame:
    """Remove the rows that meet a condition, in one scan."""
    ref = TableRef.parse(ref)
    _keys(spark, ref)
    df = tables.fresh(spark, ref)
    hit = F.coalesce(condition, F.lit(False))
    row = {c: F.col(quote(c)) for c in df.columns}
    return _commit(_out(df, [F.when(~hit, _row("rows", row, F.lit(None))), F.when(hit, _row("changes", row, F.lit("delete")))]), ref)


def overwrite_logged(ref: TableRef | str, rows: DataFrame, by: Sequence[str] | str) -> DataFrame:
    """Replace the rows that share their ``by`` values (NULL is one) with some new row; the others are not joined.

    Of the replaced ones, those with the key of a new row are updates, or nothing where all columns are equal.
    """
    ref = TableRef.parse(ref)
    spark = rows.sparkSession
    keys, target = _keys(spark, ref), tables.fresh(spark, ref)
    parts = resolve_columns(as_list(by), target.columns, "by")
    with tables.staged(tables.by_target(rows, target), ref) as stored:
        same_part = [F.col(f"t.{quote(c)}").eqNullSafe(F.col(f"p.{quote(c)}")) for c in parts]
        touched = stored.select(*parts).distinct()
        touched = (F.broadcast(touched) if fits_broadcast(stored.select(*parts)) else touched).alias("p")
        rest = target.alias("t").join(touched, same_part, "left_anti")
        plain = {c: F.col(quote(c)) for c in target.columns}
        kinds = {f.name: f.dataType for f in target.schema}
        old, new = ({c: F.col(f"{side}.{quote(c)}") for c in target.columns} for side in "tb")
        same = [old[k] == new[k] for k in keys]
        changed = differ([(comparable(old[c], kinds[c]), comparable(new[c], kinds[c])) for c in target.columns if c not in keys])
        was, is_ = F.col("t.__in").isNotNull(), F.col("b.__in").isNotNull()
        met = target.alias("t").join(touched, same_part, "left_semi").withColumn("__in", F.lit(True)).alias("t").join(
            stored.withColumn("__in", F.lit(True)).alias("b"), same, "full")
        images = [
            F.when(is_, _row("rows", new, F.lit(None))),
            F.when(was & (~is_ | changed), _row("changes", old, F.when(is_, "update_preimage").otherwise("delete"))),
            F.when(is_ & (~was | changed), _row("changes", new, F.when(was, "update_postimage").otherwise("insert"))),
        ]
        return _commit(_out(rest, [_row("rows", plain, F.lit(None))]).unionByName(_out(met, images)), ref)


def covers(spark: SparkSession, ref: TableRef | str, after: int) -> bool:
    """Whether the log holds all changes since a version."""
    ref = TableRef.parse(ref)
    return int(tables.properties(spark, ref)[FIRST_PROPERTY]) <= after <= version(spark, ref)


def forget_before(spark: SparkSession, ref: TableRef | str, number: int) -> None:
    """Changes up to a version are not asked for any more, and the files of versions before it may be removed."""
    ref = TableRef.parse(ref)
    first = int(tables.properties(spark, ref)[FIRST_PROPERTY])
    number = min(number, version(spark, ref))
    tables.set_properties(spark, ref, {FIRST_PROPERTY: str(max(number, first))})
    for old in range(first, number):
        spark.sql(f"ALTER TABLE {ref.sql} UNSET TBLPROPERTIES IF EXISTS ({sql_text(f'{ENTRY_PROPERTY}{old}')})")


def changes_between(spark: SparkSession, ref: TableRef | str, after: int, upto: int | None = None) -> DataFrame:
    """The logged changes of the versions after one, up to another (the present one), with their ``_version``.

    Reads the log alone: no version of the table.
    """
    ref = TableRef.parse(ref)
    now, place, known = version(spark, ref), tables.location(spark, ref), tables.properties(spark, ref)
    upto = now if upto is None else upto
    if not covers(spark, ref, after) or not after <= upto <= now:
        raise ValueError(f"the log of {ref.sql} does not hold the changes from version {after} to {upto}")
    rows = tables.fresh(spark, ref).schema
    logged = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows], *[T.StructField(c, T.StringType()) for c in (CHANGE_TYPE, _VERSION, _KIND)]])
    folders = [_PLACE.search(place if n == now else known[f"{ENTRY_PROPERTY}{n}"])[1] for n in range(after + 1, upto + 1)]
    if not folders:
        read = spark.createDataFrame([], logged)
    else:
        read = spark.read.schema(logged).option("basePath", _root(spark, ref)).parquet(*folders)
    return read.filter(F.col(_KIND) == "changes").select(
        *[F.col(quote(f.name)) for f in rows], CHANGE_TYPE, F.split_part(F.col(_VERSION), F.lit("_"), F.lit(1)).cast("bigint").alias(VERSION))


def net_changes(changes: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """What changes of several versions amount to: per key the first image before and the last after.

    A row that came and went, or that is as it was, is left out.  Aggregated before it is shuffled.
    """
    keys = resolve_columns(as_list(key), changes.columns, "key")
    columns = [c for c in changes.columns if c not in (CHANGE_TYPE, VERSION)]
    kinds = {f.name: f.dataType for f in changes.schema}
    was = F.col(CHANGE_TYPE).isin("delete", "update_preimage")
    image, at = F.struct(*[F.col(quote(c)).alias(c) for c in columns]), F.col(VERSION)
    merged = changes.groupBy(*[F.col(quote(k)).alias(f"__key{i}") for i, k in enumerate(keys)]).agg(
        F.min(at).alias("first"), F.max(at).alias("last"),
        F.min(F.when(was, at)).alias("first_before"), F.max(F.when(~was, at)).alias("last_after"),
        F.min_by(F.when(was, image), F.when(was, at)).alias("before"), F.max_by(F.when(~was, image), F.when(~was, at)).alias("after"))
    had, has = F.coalesce(F.col("first_before") == F.col("first"), F.lit(False)), F.coalesce(F.col("last_after") == F.col("last"), F.lit(False))
    old, new = ({c: F.col(f"{side}.{quote(c)}") for c in columns} for side in ("before", "after"))
    changed = differ([(comparable(old[c], kinds[c]), comparable(new[c], kinds[c])) for c in columns if c not in keys])
    label = lambda side, kind: F.struct(*[c.alias(n) for n, c in side.items()], kind.alias(CHANGE_TYPE))
    return merged.select(F.explode(F.array(
        F.when(had & (~has | changed), label(old, F.when(has, "update_preimage").otherwise("delete"))),
        F.when(has & (~had | changed), label(new, F.when(had, "update_postimage").otherwise("insert"))))).alias("__row")).filter(
        F.col("__row").isNotNull()).select("__row.*")
