"""Sums of doubles that come out the same whatever the order of the rows.

Adding doubles rounds at each step, so a sum depends on how rows fell into tasks. Here a double is
taken apart into whole numbers at fixed binary places, 24 bits each. Whole numbers add up exactly,
before and after the shuffle, and the total is put together once, at the end.

A place's sum stays within a bigint for 2^39 (5 x 10^11) values a group; beyond that Spark raises
an overflow. Bits below 2^-72 (2 x 10^-22) are cut off each value. Values from 2^53 up, infinities
and NaN have no places: they are added as doubles, so that such a total is as Spark's own.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACE_BITS = 24
#: Exponents of the places, lowest first. Below the highest, a place holds less than 2^24.
PLACES = {"p0": -72, "p1": -48, "p2": -24, "p3": 0, "p4": 24}
BEYOND = "beyond"
LIMIT = 2.0**53
SUM_TYPE = f"struct<{', '.join(f'{name}: bigint' for name in PLACES)}, {BEYOND}: double>"


def _placed(value: Column) -> list[Column]:
    """The whole numbers at the places of a value below the limit; nulls otherwise.

    Remainders and scalings by powers of two are exact; the cast cuts toward zero.
    """
    value = F.when(F.abs(value) < LIMIT, value)
    *lower, top = PLACES.values()
    parts = [value % F.lit(2.0 ** (place + PLACE_BITS)) for place in lower]
    scaled = zip([*parts, value], [*lower, top], strict=True)
    return [(part * F.lit(2.0**-place)).cast("bigint") for part, place in scaled]


def exact_sum(name: str) -> Column:
    """Aggregate: the sum of a double column in parts, for ``sum_value`` and ``merged_sum``."""
    value = F.col(name).cast("double")
    sums = [F.sum(part).alias(place) for part, place in zip(_placed(value), PLACES, strict=True)]
    beyond = F.sum(F.when(~(F.abs(value) < LIMIT), value))
    return F.struct(*sums, beyond.alias(BEYOND))


def merged_sum(name: str) -> Column:
    """Aggregate: the sum of a column of sums in parts."""
    return F.struct(*[F.sum(f"{name}.{part}").alias(part) for part in (*PLACES, BEYOND)])


def sum_value(parts: Column) -> Column:
    """A sum in parts as a double; null where nothing was added.

    Carries leave 24 bits in each lower place, so the two highest are exact together and adding
    from the lowest rounds within one unit of the last place.
    """
    terms, carry = [], F.lit(0).cast("bigint")
    *lower, top = PLACES
    for name in lower:
        number = parts[name] + carry
        terms.append(number.bitwiseAND(F.lit(2**PLACE_BITS - 1)) * F.lit(2.0 ** PLACES[name]))
        carry = F.shiftright(number, PLACE_BITS)
    whole = (parts[top] + carry) * F.lit(2.0 ** PLACES[top]) + terms.pop()
    total = reduce(add, terms) + whole
    beyond = parts[BEYOND]
    return F.when(total.isNull(), beyond).otherwise(total + F.coalesce(beyond, F.lit(0.0)))
