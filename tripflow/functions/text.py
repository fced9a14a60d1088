"""Display text for numbers and times.

``format_number`` rounds ties to even on the exact binary value. Where the display has no
thousands separator the comma is taken out again rather than using ``format_string``, which
rounds ties up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.schemas import HOUR_FORMAT, TIME_FORMAT


def whole(value: Column) -> Column:
    """``1,234``"""
    return F.format_number(value, 0)


def signed_whole(value: Column) -> Column:
    """``+1,234``"""
    return F.concat(F.lit("+"), whole(value))


def money(value: Column, digits: int = 2) -> Column:
    """``$1,234.57``"""
    return F.concat(F.lit("$"), F.format_number(value, digits))


def plain(value: Column, digits: int) -> Column:
    """``1234.57``"""
    return F.translate(F.format_number(value, digits), ",", "")


def miles(value: Column, digits: int = 2) -> Column:
    """``3.00 mi``"""
    return F.concat(plain(value, digits), F.lit(" mi"))


def minutes(value: Column) -> Column:
    """``27.5 min``"""
    return F.concat(plain(value, 1), F.lit(" min"))


def hour_label(hour: Column) -> Column:
    """``07:00``"""
    return F.format_string(HOUR_FORMAT, hour)


def time_label(time: Column) -> Column:
    """``Jan 05, 09:07``"""
    return F.date_format(time, TIME_FORMAT)


def percent(share: Column) -> Column:
    """``12.3%``"""
    return F.concat(plain(share * 100, 1), F.lit("%"))
