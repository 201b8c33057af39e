"""Portable functions: columns in, a column out, all inside Spark's code generation."""

from tablewright.functions.aggregates import any_value, bool_or, listagg, listagg_rows
from tablewright.functions.dates import (
    current_timestamp, date_from_parts, date_trunc, dateadd, datediff, last_day,
)
from tablewright.functions.values import (
    array_append, array_concat, array_construct, assert_not_null, bool_to_text, cast, concat, hash_text,
    length, literal, position, replace, right, safe_cast, split_part, string_literal,
)

__all__ = [
    "any_value", "array_append", "array_concat", "array_construct", "assert_not_null", "bool_or", "bool_to_text",
    "cast", "concat", "current_timestamp", "date_from_parts", "date_trunc", "dateadd", "datediff", "hash_text",
    "last_day", "length", "listagg", "listagg_rows", "literal", "position", "replace", "right", "safe_cast",
    "split_part", "string_literal",
]
