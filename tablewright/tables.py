"""Storing DataFrames as catalog tables.

Every full write goes to a directory of its own (a *version*) and the catalog is
pointed at it afterwards, so a reader sees the old rows or the new ones and a
failed or retried job leaves the table as it was.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tablewright.naming import TableRef, as_list, quote, resolve_columns, sql_text

SHARED_PROPERTY = "tablewright.shared_location"
ROOT_PROPERTY = "tablewright.location_root"
# Partitions lie elsewhere than below the table's location, or files below it are no partitions any more.
MOVED_PROPERTY = "tablewright.moved_partitions"
# Names of columns that files may still hold though the table has dropped them.
DROPPED_PROPERTY = "tablewright.dropped_columns"
# One property for each table that reads some of the same files.
SHARER_PREFIX = "tablewright.sharer."
_LAYOUT_PROPERTIES = (SHARED_PROPERTY, ROOT_PROPERTY, MOVED_PROPERTY, DROPPED_PROPERTY)
# Partitions named in one statement to the catalog.
_PER_STATEMENT = 200
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_VERSION = re.compile(r"/v([^/]*)_[0-9a-f]{12}/?$")
FORMATS = ("csv", "parquet", "delta")


@dataclass(frozen=True)
class Storage:
    """How a table is laid out; ``clustered_by`` counts only together with ``buckets``."""

    fmt: str = "parquet"
    partition_by: Sequence[str] | str | None = None
    clustered_by: Sequence[str] | str | None = None
    buckets: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    properties: Mapping[str, str] = field(default_factory=dict)
    location_root: str | None = None
    comment: str | None = None


# ---------------------------------------------------------------- catalog facts


def table_kind(spark: SparkSession, ref: TableRef) -> str | None:
    """``"table"``, ``"view"`` or None."""
    if not spark.catalog.tableExists(ref.sql):
        return None
    kind = spark.catalog.getTable(ref.sql).tableType
    return "view" if kind in ("VIEW", "TEMPORARY") else "table"


def require_table(spark: SparkSession, ref: TableRef) -> None:
    kind = table_kind(spark, ref)
    if kind != "table":
        raise ValueError(f"{ref.sql} must be a table, found {kind or 'nothing'}")


def fresh(spark: SparkSession, ref: TableRef) -> DataFrame:
    """The table as the catalog has it now; a session may still hold files another one replaced."""
    spark.catalog.refreshTable(ref.sql)
    return spark.table(ref.sql)


def describe(spark: SparkSession, ref: TableRef) -> tuple[list[str], dict[str, str]]:
    """Partition columns and the detail section of the catalog's description of a table."""
    parts: list[str] = []
    details: dict[str, str] = {}
    section = ""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {ref.sql}").collect():
        if row.col_name.startswith("# "):
            section = section if row.col_name == "# col_name" else row.col_name
        elif row.col_name and section == "# Partition Information":
            parts.append(row.col_name)
        elif row.col_name and section:
            details[row.col_name] = row.data_type
    return parts, details


def properties(spark: SparkSession, ref: TableRef) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {ref.sql}").collect()
    return {r.key: r.value for r in rows}


def location(spark: SparkSession, ref: TableRef) -> str:
    return describe(spark, ref)[1]["Location"]


def places(spark: SparkSession, ref: TableRef) -> list[str]:
    """The directory of a table, and those of its partitions that may lie elsewhere."""
    moved = MOVED_PROPERTY in properties(spark, ref)
    return [location(spark, ref), *([_partition_place(spark, ref, s) for s in _specs(spark, ref)] if moved else [])]


def version_folder(spark: SparkSession, ref: TableRef) -> str:
    """Where the versions of a table are written."""
    return f"{(storage_of(spark, ref).location_root or _default_root(spark, ref)).rstrip('/')}/{ref.name}"


def partition_columns(spark: SparkSession, ref: TableRef) -> list[str]:
    return describe(spark, ref)[0]


def storage_of(spark: SparkSession, ref: TableRef) -> Storage:
    """The layout an existing table was created with, for a rewrite."""
    parts, details = describe(spark, ref)
    buckets = details.get("Num Buckets", "")
    buckets = int(buckets) if buckets.isdigit() else 0
    clustered = [c.strip(" `") for c in details.get("Bucket Columns", "").strip("[]").split(",")]
    found = properties(spark, ref)
    kept = {
        k: v for k, v in found.items()
        if not k.startswith(("transient_", "spark.", "option.", SHARER_PREFIX)) and k not in _LAYOUT_PROPERTIES
    }
    stored = details.get("Storage Properties", "").strip("[]")
    options = dict(o.split("=", 1) for o in stored.split(", ") if "=" in o)
    return Storage(
        fmt=details.get("Provider", "parquet").lower(),
        partition_by=parts or None,
        clustered_by=clustered if buckets else None,
        buckets=buckets or None,
        options={k: v for k, v in options.items() if k not in ("path", "serialization.format")},
        properties=kept,
        location_root=found.get(ROOT_PROPERTY),
        comment=details.get("Comment"),
    )


def _default_root(spark: SparkSession, ref: TableRef) -> str:
    return spark.catalog.getDatabase(ref.namespace_sql).locationUri.rstrip("/")


# ---------------------------------------------------------------- writing


def gathered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows brought together by partition before they are written, so that a task does not leave a
    small file in every partition.  Adaptive execution splits a partition too big for one task."""
    return df.hint("rebalance", *parts) if parts else df


def _new_version(df: DataFrame, ref: TableRef, storage: Storage, tag: str = "") -> TableRef:
    """Write the rows to a fresh directory under a hidden catalog name."""
    spark = df.sparkSession
    if storage.fmt not in FORMATS:
        raise ValueError(f"unknown file format {storage.fmt!r}; use one of {', '.join(FORMATS)}")
    if storage.fmt == "delta":
        raise NotImplementedError("Delta tables need Delta Lake's own commits; store the table as parquet")
    version = f"v{tag}_{uuid.uuid4().hex[:12]}"
    root = (storage.location_root or _default_root(spark, ref)).rstrip("/")
    staged = ref.sibling(f"{ref.name}__{version}")
    parts = resolve_columns(as_list(storage.partition_by), df.columns, "partition_by")
    writer = gathered(df, parts).write.format(storage.fmt).options(**dict(storage.options))
    if parts:
        writer = writer.partitionBy(*parts)
    clustered = resolve_columns(as_list(storage.clustered_by), df.columns, "clustered_by")
    if clustered and storage.buckets:
        writer = writer.bucketBy(storage.buckets, *clustered)
    writer.option("path", f"{root}/{ref.name}/{version}").saveAsTable(staged.sql)
    return staged


def _swaps_in(spark: SparkSession, staged: TableRef, ref: TableRef, storage: Storage) -> bool:
    """Whether the table can simply be pointed at the new files: same layout, same columns.

    A partitioned table cannot: the catalog lists its partitions one by one.
    """
    have = storage_of(spark, ref)
    layout = lambda s: (s.fmt, as_list(s.partition_by), as_list(s.clustered_by) if s.buckets else [], s.buckets)
    fields = lambda r: [(f.name, f.dataType) for f in spark.table(r.sql).schema]
    return not as_list(storage.partition_by) and layout(have) == layout(storage) and fields(ref) == fields(staged)


def _publish(spark: SparkSession, staged: TableRef, ref: TableRef, storage: Storage) -> None:
    """Point the table at the staged version; a table of another shape is replaced."""
    if table_kind(spark, ref) == "table" and _swaps_in(spark, staged, ref, storage):
        had = storage_of(spark, ref)
        others = sharers(spark, ref)
        spark.sql(f"ALTER TABLE {ref.sql} SET LOCATION {sql_text(location(spark, staged))}")
        # What the table said about itself and is not said again goes, as when it is replaced under its name.
        unset_properties(spark, ref, [*(k for k in had.properties if k not in storage.properties), *_LAYOUT_PROPERTIES,
                                      *map(_key, others)])
        _release(spark, ref, others)
        if had.comment and not storage.comment:
            spark.sql(f"COMMENT ON TABLE {ref.sql} IS NULL")
        spark.sql(f"DROP TABLE {staged.sql}")  # external: the files stay
    else:
        drop(spark, ref)
        spark.sql(f"ALTER TABLE {staged.sql} RENAME TO {ref.sql}")
    spark.catalog.refreshTable(ref.sql)


def set_properties(spark: SparkSession, ref: TableRef, values: Mapping[str, str]) -> None:
    if values:
        body = ", ".join(f"{sql_text(k)} = {sql_text(str(v))}" for k, v in values.items())
        spark.sql(f"ALTER TABLE {ref.sql} SET TBLPROPERTIES ({body})")


def unset_properties(spark: SparkSession, ref: TableRef, names: Sequence[str]) -> None:
    if names:
        spark.sql(f"ALTER TABLE {ref.sql} UNSET TBLPROPERTIES IF EXISTS ({', '.join(map(sql_text, names))})")


def write_table(df: DataFrame, ref: TableRef | str, storage: Storage = Storage(), tag: str = "") -> DataFrame:
    """Create the table from a DataFrame, or replace whatever has its name."""
    ref = TableRef.parse(ref)
    spark = df.sparkSession
    staged = _new_version(df, ref, storage, tag)
    _publish(spark, staged, ref, storage)
    root = {ROOT_PROPERTY: storage.location_root} if storage.location_root else {}
    set_properties(spark, ref, {**storage.properties, **root})
    if storage.comment:
        spark.sql(f"COMMENT ON TABLE {ref.sql} IS {sql_text(storage.comment)}")
    return spark.table(ref.sql)


def version_tag(spark: SparkSession, ref: TableRef) -> str:
    """What the directory of a table's version says beside its random name."""
    found = _VERSION.search(location(spark, ref))
    return found[1] if found else ""


def rewrite(df: DataFrame, ref: TableRef, tag: str | None = None) -> DataFrame:
    """Replace a table's rows, keeping its layout, options, properties, comments and (else than given) its tag.

    ``df`` may read the table itself: the new version is a directory of its own.
    """
    spark = df.sparkSession
    tag = version_tag(spark, ref) if tag is None else tag
    about = {f.name.lower(): f.metadata for f in spark.table(ref.sql).schema if f.metadata}
    documented = df.select(*[
        F.col(quote(c)).alias(c, metadata=about[c.lower()]) if c.lower() in about else F.col(quote(c))
        for c in df.columns])
    return write_table(documented, ref, storage_of(spark, ref), tag)


def materialize_table(
    model: Callable[[], DataFrame] | DataFrame,
    ref: TableRef | str,
    storage: Storage = Storage(),
    pre: Sequence[Callable[[], object]] = (),
    post: Sequence[Callable[[], object]] = (),
) -> DataFrame:
    """Build a model as a table; hooks run before and after."""
    for hook in pre:
        hook()
    df = model() if callable(model) else model
    table = write_table(df, ref, storage)
    for hook in post:
        hook()
    return table


def materialize_view(
    spark: SparkSession,
    query: str,
    ref: TableRef | str,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
) -> DataFrame:
    """Create or replace a stored view over catalog tables; a table of that name goes first."""
    ref = TableRef.parse(ref)
    if table_kind(spark, ref) == "table":
        drop(spark, ref)
    columns = spark.sql(query).columns
    comments = column_comments or {}
    resolve_columns(list(comments), columns, "column_comments")
    by_name = {k.lower(): v for k, v in comments.items()}
    listed = ", ".join(
        quote(c) + (f" COMMENT {sql_text(by_name[c.lower()])}" if c.lower() in by_name else "") for c in columns
    )
    about = f" COMMENT {sql_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {ref.sql} ({listed}){about} AS {query}")
    return spark.table(ref.sql)


def drop(spark: SparkSession, ref: TableRef | str) -> None:
    """Drop a table or view of that name, if there is one."""
    ref = TableRef.parse(ref)
    kind = table_kind(spark, ref)
    others = sharers(spark, ref) if kind == "table" else []
    if kind:
        spark.sql(f"DROP {kind.upper()} IF EXISTS {ref.sql}")
    _release(spark, ref, others)


# ---------------------------------------------------------------- shared files


def _key(ref: TableRef) -> str:
    return SHARER_PREFIX + ref.sql


def _named(ref: TableRef) -> dict[str, str]:
    """The property by which another table names this one."""
    return {_key(ref): json.dumps([ref.name, ref.namespace, ref.catalog])}


def sharers(spark: SparkSession, ref: TableRef) -> list[TableRef]:
    """The tables that may read some of this table's files."""
    return [TableRef(*json.loads(v)) for k, v in sorted(properties(spark, ref).items()) if k.startswith(SHARER_PREFIX)]


def _release(spark: SparkSession, ref: TableRef, others: Sequence[TableRef]) -> None:
    """Tables no longer share files with this one, which has stopped reading them; one left alone owns them.

    Marks go after the files are let go and come before they are shared: a job that dies between the two leaves
    a table that copies without need, never one that overwrites what another reads.
    """
    for other in others:
        if table_kind(spark, other) == "table":
            unset_properties(spark, other, [_key(ref)])
            if not sharers(spark, other):
                unset_properties(spark, other, [SHARED_PROPERTY])


def moved_name(spark: SparkSession, old: TableRef, new: TableRef) -> None:
    """Sharers of a table that was renamed know it by its new name."""
    for other in sharers(spark, new):
        if table_kind(spark, other) == "table":
            unset_properties(spark, other, [_key(old)])
            set_properties(spark, other, _named(new))


def _specs(spark: SparkSession, ref: TableRef) -> list[str]:
    """The partitions as the catalog names them, which is also the path below the table: ``a=1/b=x``."""
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {ref.sql}").collect()]


def _spec_sql(spec: str) -> str:
    """Such a name as SQL."""
    named = [part.split("=", 1) for part in spec.split("/")]
    return ", ".join(f"{quote(unquote(k))} = {'NULL' if v == _NULL_PARTITION else sql_text(unquote(v))}" for k, v in named)


def _add_partitions(spark: SparkSession, ref: TableRef, places: Mapping[str, str]) -> None:
    """Register partitions, each with its directory."""
    listed = [f"PARTITION ({_spec_sql(s)}) LOCATION {sql_text(p)}" for s, p in places.items()]
    for at in range(0, len(listed), _PER_STATEMENT):
        spark.sql(f"ALTER TABLE {ref.sql} ADD IF NOT EXISTS {' '.join(listed[at:at + _PER_STATEMENT])}")


def _partition_place(spark: SparkSession, ref: TableRef, spec: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ref.sql} PARTITION ({_spec_sql(spec)})").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def _same_partitions(spark: SparkSession, src: TableRef, dst: TableRef) -> None:
    """Give a new table at the same location the partitions of another one."""
    if not partition_columns(spark, dst):
        return
    if MOVED_PROPERTY in properties(spark, src):
        _add_partitions(spark, dst, {s: _partition_place(spark, src, s) for s in _specs(spark, src)})
    else:
        spark.sql(f"MSCK REPAIR TABLE {dst.sql}")


def clone(spark: SparkSession, src: TableRef | str, dst: TableRef | str, full_refresh: bool = False) -> DataFrame:
    """A copy that shares the source's files; a view when the source is one.

    An existing target is left alone unless ``full_refresh``.  Each table names the others that share its files.
    While there are any, a change of a partitioned table writes the touched partitions to new directories and points
    the catalog there; all others stay shared.  An unpartitioned table takes its own copy at its first change in
    place.  The table that is left when the others are dropped or rewritten owns the files and changes them in place.
    """
    src, dst = TableRef.parse(src), TableRef.parse(dst)
    if table_kind(spark, dst) and not full_refresh:
        return spark.table(dst.sql)
    if table_kind(spark, src) == "view":
        return materialize_view(spark, f"SELECT * FROM {src.sql}", dst)
    require_table(spark, src)
    drop(spark, dst)
    family = [src, *(r for r in sharers(spark, src) if table_kind(spark, r) == "table")]
    for ref in family:
        set_properties(spark, ref, {SHARED_PROPERTY: "true", **_named(dst)})
    spark.sql(f"CREATE TABLE {dst.sql} LIKE {src.sql} LOCATION {sql_text(location(spark, src))}")
    found = properties(spark, src)
    set_properties(spark, dst, {
        SHARED_PROPERTY: "true", **{k: found[k] for k in (MOVED_PROPERTY, DROPPED_PROPERTY) if k in found},
        **{k: v for ref in family for k, v in _named(ref).items()}})
    _same_partitions(spark, src, dst)
    return spark.table(dst.sql)


def _shares(spark: SparkSession, ref: TableRef) -> bool:
    return properties(spark, ref).get(SHARED_PROPERTY) == "true"


def own_files(spark: SparkSession, ref: TableRef) -> None:
    """Before a change in place: a table that shares files with a clone gets its own."""
    if _shares(spark, ref):
        rewrite(fresh(spark, ref), ref)


def _move_partitions(df: DataFrame, ref: TableRef) -> None:
    """Replace the partitions that ``df`` has rows for by new directories; no file is overwritten.

    The new rows are written first.  Then each partition is pointed at its directory, by one step of the catalog.
    """
    spark = df.sparkSession
    staged = _new_version(df, ref, storage_of(spark, ref), version_tag(spark, ref))
    root, known = location(spark, staged), set(_specs(spark, ref))
    places = {spec: f"{root}/{spec}" for spec in _specs(spark, staged)}
    set_properties(spark, ref, {MOVED_PROPERTY: "true"})
    _add_partitions(spark, ref, {s: p for s, p in places.items() if s not in known})
    for spec in known & places.keys():
        spark.sql(f"ALTER TABLE {ref.sql} PARTITION ({_spec_sql(spec)}) SET LOCATION {sql_text(places[spec])}")
    spark.sql(f"DROP TABLE {staged.sql}")  # external: the files stay
    spark.catalog.refreshTable(ref.sql)


def _append_apart(df: DataFrame, ref: TableRef, parts: Sequence[str]) -> None:
    """Add rows to a table that shares files: the partitions they fall into are copied, new ones are only written."""
    spark = df.sparkSession
    with staged(by_target(df, spark.table(ref.sql)), ref) as batch:
        touched = [tuple(r) for r in batch.select(*map(quote, parts)).distinct().collect()]
        _move_partitions(in_partitions(fresh(spark, ref), parts, touched).unionByName(batch), ref)


def append_rows(df: DataFrame, ref: TableRef) -> DataFrame:
    """Add rows in place, by the table's column list."""
    spark = df.sparkSession
    parts = partition_columns(spark, ref)
    if parts and _shares(spark, ref):
        _append_apart(df, ref, parts)
        return spark.table(ref.sql)
    own_files(spark, ref)
    gathered(by_target(df, spark.table(ref.sql)), parts).write.insertInto(ref.sql)
    spark.catalog.refreshTable(ref.sql)
    return spark.table(ref.sql)


def by_target(df: DataFrame, target: DataFrame) -> DataFrame:
    """The columns of ``df`` the target has, in its order and types; a missing one is an error."""
    found = resolve_columns(target.columns, df.columns, "batch")
    return df.select(*[F.col(quote(c)).cast(f.dataType).alias(f.name) for c, f in zip(found, target.schema)])


_overwrite_mode = threading.Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Inserts replace only the partitions they write to (a write option is ignored there)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    with _overwrite_mode:
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(key, before)


def overwrite_partitions(df: DataFrame, ref: TableRef) -> DataFrame:
    """Replace exactly the partitions that ``df`` has rows for; ``df`` may read the table."""
    spark = df.sparkSession
    parts = partition_columns(spark, ref)
    if parts and _shares(spark, ref):
        _move_partitions(by_target(df, spark.table(ref.sql)), ref)
        return spark.table(ref.sql)
    own_files(spark, ref)
    rows = gathered(by_target(df, spark.table(ref.sql)), parts)
    with _dynamic_overwrite(spark):
        rows.write.mode("overwrite").insertInto(ref.sql)
    spark.catalog.refreshTable(ref.sql)
    return spark.table(ref.sql)


def _one_of(column: str, values: set[object]) -> Column:
    """Whether a column has one of the values, NULL included; never NULL."""
    known, test = [v for v in values if v is not None], F.lit(False)
    if known:
        test = F.coalesce(F.col(quote(column)).isin(known), F.lit(False)) if None in values else F.col(quote(column)).isin(known)
    return test | F.col(quote(column)).isNull() if None in values else test


def in_partitions(df: DataFrame, columns: Sequence[str], values: Sequence[Sequence[object]]) -> DataFrame:
    """The rows of some partitions, NULL included, however many there are.

    A flat list for each column prunes at planning time.  Of several columns these lists admit every
    combination, so the partitions themselves are then looked up; the catalog has them on the driver too.
    """
    for i, column in enumerate(columns):
        df = df.filter(_one_of(column, {v[i] for v in values}))
    if len(columns) == 1:
        return df
    schema = StructType([StructField(f"__p{i}", df.schema[c].dataType) for i, c in enumerate(columns)])
    wanted = df.sparkSession.createDataFrame([tuple(v) for v in values], schema)
    same = reduce(lambda a, b: a & b, [F.col(quote(c)).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(columns)])
    return df.join(F.broadcast(wanted), same, "left_semi")


def _literal(value: object) -> str:
    """A partition value as SQL text; numbers and booleans bare, dates and text quoted."""
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float, Decimal)):
        return str(value).lower()
    kind = "TIMESTAMP " if isinstance(value, datetime) else "DATE " if isinstance(value, date) else ""
    return kind + sql_text(str(value))


def empty_partitions(spark: SparkSession, ref: TableRef, columns: Sequence[str],
                     values: Sequence[Sequence[object]]) -> None:
    """Remove all rows of some partitions, files first, then the catalog entries; shared files stay."""
    if _shares(spark, ref):
        set_properties(spark, ref, {MOVED_PROPERTY: "true"})
        for row in values:
            spec = ", ".join(f"{quote(c)} = {_literal(v)}" for c, v in zip(columns, row))
            spark.sql(f"ALTER TABLE {ref.sql} DROP IF EXISTS PARTITION ({spec})")
        spark.catalog.refreshTable(ref.sql)
        return
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})"
                        for f in spark.table(ref.sql).schema if f.name not in columns)
    for row in values:
        spec = ", ".join(f"{quote(c)} = {_literal(v)}" for c, v in zip(columns, row))
        spark.sql(f"INSERT OVERWRITE TABLE {ref.sql} PARTITION ({spec}) SELECT {nothing} WHERE false")
        if all(v is not None for v in row):
            spark.sql(f"ALTER TABLE {ref.sql} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(ref.sql)


# ---------------------------------------------------------------- columns without a rewrite


def redeclare(spark: SparkSession, ref: TableRef, schema: StructType, dropped: Sequence[str]) -> None:
    """Give a table other columns over the same files; the caller sees to it that the files can be read so.

    The entry is made anew beside the old one and takes its name: two steps of the catalog, as when a table of another
    shape is published.  Partitions, layout, options, comments and sharers stay.  ``dropped`` names are remembered:
    a new column of such a name would show the old values.
    """
    had, found, details = storage_of(spark, ref), properties(spark, ref), describe(spark, ref)[1]
    beside = ref.sibling(f"{ref.name}__columns_{uuid.uuid4().hex[:12]}")
    parts = as_list(had.partition_by)
    columns = ", ".join(
        f"{quote(f.name)} {f.dataType.simpleString()}"
        + (f" COMMENT {sql_text(f.metadata['comment'])}" if "comment" in f.metadata else "")
        for f in sorted(schema, key=lambda f: f.name in parts))
    listed = lambda names: ", ".join(map(quote, names))
    options = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in had.options.items())
    spark.sql(
        f"CREATE TABLE {beside.sql} ({columns}) USING {had.fmt}"
        + (f" OPTIONS ({options})" if options else "")
        + (f" PARTITIONED BY ({listed(parts)})" if parts else "")
        + (f" CLUSTERED BY ({listed(had.clustered_by)}) INTO {had.buckets} BUCKETS" if had.buckets else "")
        + f" LOCATION {sql_text(details['Location'])}"
        + (f" COMMENT {sql_text(had.comment)}" if had.comment else ""))
    _same_partitions(spark, ref, beside)
    kept = {k: v for k, v in found.items() if k in _LAYOUT_PROPERTIES or k.startswith(SHARER_PREFIX)}
    gone = sorted({*json.loads(found.get(DROPPED_PROPERTY, "[]")), *(n.lower() for n in dropped)})
    set_properties(spark, beside, {**had.properties, **kept, **({DROPPED_PROPERTY: json.dumps(gone)} if gone else {})})
    spark.sql(f"DROP TABLE {ref.sql}")  # external: the files stay
    spark.sql(f"ALTER TABLE {beside.sql} RENAME TO {ref.sql}")
    spark.catalog.refreshTable(ref.sql)


def still_stored(spark: SparkSession, ref: TableRef) -> set[str]:
    """Names (in small letters) of dropped columns that files of the table may still hold."""
    return set(json.loads(properties(spark, ref).get(DROPPED_PROPERTY, "[]")))


# ---------------------------------------------------------------- staging and preview


@contextmanager
def staged(df: DataFrame, ref: TableRef):
    """A batch stored beside its target while the target is changed.

    It is read several times, so it is computed once; and as a stored table it
    has a known size, which decides how it is joined.
    """
    spark = df.sparkSession
    name = ref.sibling(f"{ref.name}__batch_{uuid.uuid4().hex[:12]}")
    df.write.format("parquet").saveAsTable(name.sql)
    try:
        yield spark.table(name.sql)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name.sql}")


def show(df: DataFrame, limit: int, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """The first rows in a stated order; without one, by all columns."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    return df.orderBy(*(as_list(order_by) or df.columns)).limit(limit)



def update_where(spark: SparkSession, ref: TableRef | str, condition: Column,
                 values: Mapping[str, Column]) -> DataFrame:
    """Set columns of the rows that meet a condition; a condition that is NULL is not met."""
    ref = TableRef.parse(ref)
    df = fresh(spark, ref)
    names = resolve_columns(list(values), df.columns, "update")
    new = dict(zip(names, values.values()))
    hit = F.coalesce(condition, F.lit(False))
    parts = partition_columns(spark, ref)
    in_place = bool(parts) and not set(parts) & set(names)
    if in_place:
        # Only the partitions with such rows are rewritten; the catalog lists their values on the driver too.
        touched = [tuple(r) for r in df.filter(hit).select(*parts).distinct().collect()]
        df = in_partitions(df, parts, touched)
    changed = df.select(*[
        F.when(hit, new[f.name].cast(f.dataType)).otherwise(F.col(quote(f.name))).alias(f.name)
        if f.name in new else F.col(quote(f.name)) for f in df.schema])
    return overwrite_partitions(changed, ref) if in_place else rewrite(changed, ref)
