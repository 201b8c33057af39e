"""Functions on text, arrays and types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def array_construct(*items: object) -> Column:
    return F.array(*[_column(i) for i in items])


def array_append(items: Column, item: object) -> Column:
    return F.array_append(items, _column(item))


def array_concat(first: Column, second: Column) -> Column:
    """Both arrays in order, copies kept."""
    return F.concat(first, second)


def concat(*fields: object) -> Column:
    """NULL when any field is."""
    return F.concat(*[_column(f) for f in fields])


def split_part(text: Column, delimiter: str | Column, number: int) -> Column:
    """The n-th part, counted from one (zero is read as one) or from the end when negative; NULL past either end.

    The delimiter may be a column; it is taken literally.
    """
    if isinstance(delimiter, Column):
        literal = F.replace(delimiter, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
        pattern = F.concat(F.lit(r"\Q"), literal, F.lit(r"\E"))
    else:
        pattern = re.escape(delimiter)
    return F.try_element_at(F.split(text, pattern), F.lit(number if number else 1))


_WHOLE_NUMBERS = {"bigint", "int", "integer", "long", "smallint", "short", "tinyint", "byte"}


def safe_cast(value: object, kind: str) -> Column:
    """NULL where the value does not convert.

    Each text that fails to become a number costs an exception inside Spark, so one with a letter in
    it, which cannot be a whole number, is not tried.
    """
    value = _column(value)
    if kind.lower() not in _WHOLE_NUMBERS:
        return value.try_cast(kind)
    hopeless = (F.typeof(value) == "string") & value.cast("string").rlike("[A-Za-z]")
    return F.when(hopeless, None).otherwise(value.try_cast(kind))


def cast(value: object, kind: str) -> Column:
    return _column(value).cast(kind)


def bool_to_text(flag: Column) -> Column:
    return flag.cast("string")


def hash_text(value: object) -> Column:
    """md5 of the value's text."""
    return F.md5(_column(value).cast("string"))


def length(text: Column) -> Column:
    return F.length(text)


def position(part: object, text: Column) -> Column:
    """Where ``part`` starts, counted from one; zero when it is absent."""
    return F.position(_column(part), text)


def replace(text: Column, old: object, new: object) -> Column:
    return F.replace(text, _column(old), _column(new))


def right(text: Column, count: Column | int) -> Column:
    return F.right(text, _column(count))


def string_literal(text: str) -> Column:
    """A text value; quotes in it need no escaping, because it never becomes SQL."""
    return F.lit(text).cast("string")


def literal(value: object, kind: str) -> Column:
    return F.lit(value).cast(kind)


def assert_not_null(value: Column, strict: bool = False) -> Column:
    """The value itself; with ``strict`` a NULL ends the job."""
    if not strict:
        return value
    return F.coalesce(value, F.raise_error(F.lit("assert_not_null: found a NULL")))
