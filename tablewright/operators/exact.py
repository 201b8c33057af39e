"""Sums of floating point that can be taken back exactly.

A double is a whole number of some power of two.  Its digits to the base 2**24 are whole numbers, so sums of
them per place neither round nor depend on order, and a deleted value leaves nothing behind.  The state of a
sum is a map from place to sum, with three places more that count NaN and the infinities; it has at most some
90 entries, mostly fewer than ten.  The places of 5 * 10**11 rows fit a bigint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.naming import quote

BITS = 24
NAN, PLUS, MINUS = 1000, 1001, 1002


def _times_two_to(value: Column, places: Column) -> Column:
    """``value * 2 ** (BITS * places)`` in two steps, since the power alone may not be a double."""
    half = F.pow(F.lit(2.0), places * F.lit(BITS // 2))
    return value * half * half


def _entry(place: Column, part: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), part.cast("bigint").alias("part"))


def digits(value: Column) -> Column:
    """The places of one double and what it adds there; none for NULL and zero."""
    size = F.abs(value)
    low = F.floor((F.log2(size) - 54) / BITS)  # the last of 53 bits, with room for the rounding of log2
    whole = _times_two_to(size, -low)
    found = [
        _entry(low + j, F.signum(value) * F.floor(whole % F.lit(2.0 ** (BITS * (j + 1))) / F.lit(2.0 ** (BITS * j))))
        for j in range(4)
    ]
    return (
        F.when(F.isnan(value), F.array(_entry(F.lit(NAN), F.lit(1))))
        .when(value == float("inf"), F.array(_entry(F.lit(PLUS), F.lit(1))))
        .when(value == float("-inf"), F.array(_entry(F.lit(MINUS), F.lit(1))))
        .when(size > 0, F.array(*found))
    )


def summed(rows: DataFrame, keys: Sequence[str], column: str, sign: Column) -> DataFrame:
    """The keys of each group and ``parts``, the sums of its places; added up before the shuffle."""
    named = [F.col(quote(k)).alias(f"__k{i}") for i, k in enumerate(keys)]
    places = rows.select(*named, sign.alias("__sign"), F.explode(digits(F.col(quote(column)).cast("double"))).alias("__d"))
    groups = [f"__k{i}" for i in range(len(keys))]
    sums = (
        places.groupBy(*groups, F.col("__d.place").alias("__place"))
        .agg(F.sum(F.col("__sign") * F.col("__d.part")).alias("__part")).filter("__part <> 0")
    )
    gathered = sums.groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(F.struct("__place", "__part"))).alias("parts"))  # a bounded number of places
    return gathered.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], "parts")


def together(a: Column, b: Column) -> Column:
    """The sum of two states; either may be NULL."""
    none = F.create_map().cast("map<int,bigint>")
    both = F.map_zip_with(F.coalesce(a, none), F.coalesce(b, none),
                          lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    return F.map_filter(both, lambda _, part: part != 0)


def _carried(parts: Column, sign: Column, low: Column, high: Column) -> Column:
    """Digits from the lowest place up with carries taken, and what is carried beyond the last: 0, or -1 below zero."""
    base = F.lit(1 << BITS).cast("bigint")
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def add(state: Column, place: Column) -> Column:
        here = F.coalesce(parts[place], F.lit(0)) * sign + state["carry"]
        return F.struct(F.shiftright(here, BITS).alias("carry"),
                        F.concat(state["digits"], F.array(F.pmod(here, base))).alias("digits"))

    return F.aggregate(F.sequence(low, high), start, add)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rounded(found: Column, low: Column) -> Column:
    """From the four highest digits, 73 bits or more; whether anything lies below shows in the last of them."""

    def from_top(top: Column) -> Column:
        digit = [F.coalesce(F.get(found, top - j), F.lit(0)) for j in range(4)]
        below = F.exists(F.slice(found, F.lit(1), F.greatest(top - 3, F.lit(0))), lambda d: d != 0)
        last = F.when(below, digit[3].bitwiseOR(F.lit(1))).otherwise(digit[3])
        upper = (digit[0] * (1 << BITS) + digit[1]).cast("double")
        lower = (digit[2] * (1 << BITS) + last).cast("double")
        return _times_two_to(upper * F.lit(2.0 ** (2 * BITS)) + lower, low + top - 3)

    return _named(F.array_max(F.transform(found, lambda d, i: F.when(d != 0, i))), from_top)


def _finite(parts: Column, places: Column) -> Column:
    one = F.lit(1).cast("bigint")

    def between(ends: Column) -> Column:
        low, high = ends["low"], ends["high"]
        below_zero = _carried(parts, one, low, high)["carry"] < 0
        return _named(F.when(below_zero, -one).otherwise(one), lambda sign: sign * _named(
            _carried(parts, sign, low, high)["digits"], lambda found: _rounded(found, low)))

    return _named(F.struct(F.array_min(places).alias("low"), (F.array_max(places) + 3).alias("high")), between)


def total(parts: Column) -> Column:
    """The sum that a state stands for, rounded once to the nearest double."""

    def of(held: Column) -> Column:
        nan, plus, minus = (F.coalesce(held[F.lit(p)], F.lit(0)) > 0 for p in (NAN, PLUS, MINUS))
        finite = _named(F.filter(F.map_keys(held), lambda p: p < NAN),
                        lambda places: F.when(F.size(places) > 0, _finite(held, places)).otherwise(0.0))
        return (
            F.when(nan | (plus & minus), float("nan")).when(plus, float("inf")).when(minus, float("-inf")).otherwise(finite)
        )

    return _named(parts, of)
