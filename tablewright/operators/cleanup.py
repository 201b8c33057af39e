"""Old versions of tables: finding those that no table reads, and freeing their space."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import tables
from tablewright.naming import TableRef, quote

_VERSION_DIR = r"^(.*/v[^/]*_[0-9a-f]{12})/"


def _plain(path: str) -> str:
    """One spelling of a place: some catalogs write ``file:/x``, others ``file:///x``."""
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", path).rstrip("/") + "/"


def _in_use(spark: SparkSession, folder: str) -> set[str]:
    """Places below a folder that any table or partition of the catalog reads.

    Clones read files of tables that have long been rewritten, and these do not name them any more, so every
    table is looked at.
    """
    places = set()
    for (namespace,) in spark.sql("SHOW NAMESPACES").collect():
        for row in spark.sql(f"SHOW TABLES IN {quote(namespace)}").filter("NOT isTemporary").collect():
            ref = TableRef(row.tableName, namespace)
            if tables.table_kind(spark, ref) == "table":
                places |= {p for p in map(_plain, tables.places(spark, ref)) if p.startswith(folder)}
    return places


def old_versions(spark: SparkSession, ref: TableRef | str, hours: float = 168) -> DataFrame:
    """Versions of a table that nothing reads and whose last file is older: version (its directory), files, bytes.

    Files are listed by Spark, their contents are not read.  A version some of whose partitions are still read is kept
    whole.  Tables that log their changes are refused, since old versions are what their readers ask for.
    """
    ref = TableRef.parse(ref)
    tables.require_table(spark, ref)
    if any(k.startswith("tablewright.log") for k in tables.properties(spark, ref)):
        raise ValueError(f"{ref.sql} logs its changes: its old versions are still asked for")
    folder = _plain(tables.version_folder(spark, ref))
    used = _in_use(spark, folder)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(
        F.regexp_extract("path", _VERSION_DIR, 1).alias("version"), "modificationTime", "length")
    found = listed.filter("version <> ''").groupBy("version").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("written"))
    age = F.current_timestamp() - F.make_dt_interval(mins=F.lit(int(hours * 60)))
    held = [v for v in {_held(p, folder) for p in used} if v]
    rows = found.filter((F.col("written") <= age) & (F.col("bytes") > 0))
    name = F.regexp_extract("version", r"([^/]*)$", 1)
    return (rows.filter(~name.isin(held)) if held else rows).select("version", "files", "bytes")


def _held(place: str, folder: str) -> str:
    """The name of the version that a place lies in."""
    return place[len(folder):].split("/", 1)[0]


def drop_old_versions(spark: SparkSession, ref: TableRef | str, hours: float = 168) -> list[str]:
    """Empty the versions that ``old_versions`` finds and name them; each leaves a directory without rows.

    ``hours`` must exceed the longest time for which a reader may hold a plan over an older version.
    """
    emptied = sorted(r.version for r in old_versions(spark, ref, hours).collect())
    for version in emptied:
        spark.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(version)
    return emptied
