"""Comparing tables by checksums: only ranges of keys whose sums differ are compared row by row.

A range's checksum is a sum of row hashes, so the order of rows does not matter and copies count.  It is summed before
the shuffle: of tables that are equal nothing but one line per task and range is moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.naming import as_list, quote, resolve_columns
from tablewright.operators.checks import relations_equal
from tablewright.operators.comparing import comparable_frame

RANGES = 1024
_RANGE = "__range"


def _alike(a: DataFrame, b: DataFrame, columns: Sequence[str] | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the compared columns, in the types that hold the values of either."""
    names = resolve_columns(list(columns), a.columns, "columns") if columns else sorted(a.columns)
    ours = comparable_frame(a, names)
    theirs = comparable_frame(b, resolve_columns(names, b.columns, "columns")).toDF(*names)
    kinds = {f.name: f.dataType for f in ours.unionByName(theirs).schema}
    cast = [F.col(quote(n)).cast(kinds[n]).alias(n) for n in names]
    return ours.select(*cast), theirs.select(*cast), names


def _range_of(names: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quote(n)) for n in names]), F.lit(ranges)).cast("int")


def range_digests(df: DataFrame, by: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """One row per range of ``by``: the number of rows and sums of two hashes of them, each in two halves."""
    cells = [F.col(quote(c)) for c in df.columns]
    hashes = [F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells)]
    sums = [F.sum(half).alias(f"sum{i}") for i, half in enumerate(
        h for x in hashes for h in (F.shiftright(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))))]
    return df.groupBy(_range_of(by, ranges).alias(_RANGE)).agg(F.count("*").alias("n"), *sums)


def differing_ranges(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, key: Sequence[str] | str | None = None,
                     ranges: int = RANGES) -> list[int]:
    """The ranges in which the two sides differ; ``ranges`` numbers at most reach the driver."""
    ours, theirs, names = _alike(a, b, columns)
    by = resolve_columns(as_list(key), names, "key") or names
    sides = [range_digests(side, by, ranges) for side in (ours, theirs)]
    facts = [c for c in sides[0].columns if c != _RANGE]
    found = sides[0].withColumn("__side", F.lit(1)).unionByName(sides[1].withColumn("__side", F.lit(-1))).groupBy(_RANGE).agg(
        F.sum("__side").alias("__side"), *[F.count_distinct(c).alias(c) for c in facts])
    test = " or ".join(["__side <> 0", *[f"{c} > 1" for c in facts]])
    return sorted(r[0] for r in found.filter(test).select(_RANGE).collect())


def relations_equal_by_ranges(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, key: Sequence[str] | str | None = None,
                              ranges: int = RANGES) -> DataFrame:
    """What ``relations_equal`` gives, from the rows of differing ranges alone.

    Reads both sides once for the checksums, and again only where they differ.  ``key`` (all columns, where it is not
    given) deals the rows into ranges: with the key a changed row touches one range, else its old and its new one.
    """
    wanted = differing_ranges(a, b, columns, key, ranges)
    ours, theirs, names = _alike(a, b, columns)
    by = resolve_columns(as_list(key), names, "key") or names
    if not wanted:
        return relations_equal(ours.limit(0), theirs.limit(0))
    hit = _range_of(by, ranges).isin(wanted)
    return relations_equal(ours.filter(hit), theirs.filter(hit))
