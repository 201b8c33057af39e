"""Comparing values of any type, maps included."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.naming import quote


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind)


def comparable(value: Column, kind: T.DataType) -> Column:
    """The value in a form that can be grouped and compared: a map becomes its sorted entries."""
    if not _has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        entries = F.map_entries(value)
        if _has_map(entry):
            entries = F.transform(entries, lambda e: comparable(e, entry))
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: comparable(e, kind.elementType))
    fields = [comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind]
    return F.when(value.isNotNull(), F.struct(*fields))


def comparable_frame(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = columns or df.columns
    return df.select(*[comparable(F.col(quote(n)), df.schema[n].dataType).alias(n) for n in names])


def differ(pairs: list[tuple[Column, Column]]) -> Column:
    """True where any pair differs, with NULL equal to NULL."""
    return reduce(lambda a, b: a | b, [~a.eqNullSafe(b) for a, b in pairs], F.lit(False))
