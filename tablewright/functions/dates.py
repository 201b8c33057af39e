"""Date and time arithmetic by named part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADD_PARTS = ("day", "week", "month", "quarter", "year", "hour", "minute", "second", "millisecond", "microsecond")

_ELAPSED_MICROS = {"hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000}


def _unknown(name: str, part: str) -> ValueError:
    return ValueError(f"{name} is not defined for part {part!r}")


def current_timestamp() -> Column:
    return F.current_timestamp()


def date_from_parts(year: Column | int, month: Column | int, day: Column | int) -> Column:
    return F.make_date(*[c if isinstance(c, Column) else F.lit(c) for c in (year, month, day)])


def dateadd(part: str, count: Column | int, start: Column) -> Column:
    """``start`` moved by whole parts, as a timestamp; the clock time is kept and month ends are clipped."""
    if part not in ADD_PARTS:
        raise _unknown("dateadd", part)
    count = count if isinstance(count, Column) else F.lit(count)
    stamp = start.cast("timestamp_ntz")
    if part == "millisecond":
        part, count = "microsecond", count * 1000
    return F.timestamp_add(part.upper(), count, stamp)


def _whole_seconds(at: Column) -> Column:
    return F.unix_seconds(at.cast("timestamp_ntz").cast("timestamp"))


def _micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp_ntz").cast("timestamp"))


def datediff(first: Column, second: Column, part: str) -> Column:
    """Parts from ``first`` to ``second``, negative when it is earlier.

    Years, quarters, months and days count calendar boundaries, weeks the Sundays crossed.
    Hours, minutes and seconds are elapsed whole seconds, and a part begun counts as one.
    """
    if part == "day":
        return F.datediff(second.cast("date"), first.cast("date")).cast("bigint")
    if part == "week":
        # 1970-01-01 was a Thursday, four days after a Sunday.
        number = lambda d: F.floor((F.unix_date(d.cast("date")) + 4) / 7)
        return number(second) - number(first)
    if part in ("month", "quarter", "year"):
        per_year = {"month": 12, "quarter": 4, "year": 1}[part]
        within = {"month": F.month, "quarter": F.quarter, "year": lambda d: F.lit(0)}[part]
        number = lambda d: F.year(d) * per_year + within(d)
        return (number(second) - number(first)).cast("bigint")
    if part in _ELAPSED_MICROS:
        seconds = _whole_seconds(second) - _whole_seconds(first)
        unit = _ELAPSED_MICROS[part] // 1_000_000
        if unit == 1:
            return seconds
        return F.when(seconds > 0, F.ceil(seconds / unit)).otherwise(F.floor(seconds / unit))
    if part == "millisecond":
        number = lambda t: F.unix_millis(t.cast("timestamp_ntz").cast("timestamp"))
        return number(second) - number(first)
    if part == "microsecond":
        return _micros(second) - _micros(first)
    raise _unknown("datediff", part)


def date_trunc(part: str, at: Column) -> Column:
    """The start of the part, as a timestamp."""
    return F.date_trunc(part, at).cast("timestamp_ntz")


def last_day(at: Column, part: str) -> Column:
    """The last date of the month, quarter or year."""
    months = {"month": 1, "quarter": 3, "year": 12}.get(part)
    if months is None:
        raise _unknown("last_day", part)
    if months == 1:
        return F.last_day(at)
    return F.date_add(F.add_months(F.trunc(at, part), months), -1)
