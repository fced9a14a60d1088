"""Expressions over trip columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.schemas import ASSUMED_SPEED_MPH, PAYMENT_LABELS, UNKNOWN


def parse_time(value: Column) -> Column:
    """Wall-clock time of a text or timestamp column; null where it does not parse.

    ``timestamp_ntz`` keeps durations and hours independent of the session time zone, and
    ``try_cast`` keeps bad text a null instead of an error under ANSI mode.
    """
    return value.try_cast("timestamp_ntz")


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two times, each cut to the whole second first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def pickup_hour(start: Column) -> Column:
    """Hour of day, 0 to 23."""
    return F.hour(start)


def payment_label(code: Column) -> Column:
    """Label of a numeric payment code. Fractions truncate; anything unlisted is unknown."""
    pairs = ", ".join(f"{number}, '{label}'" for number, label in PAYMENT_LABELS.items())
    labels = F.expr(f"map({pairs})")
    return F.coalesce(labels[code.try_cast("int")], F.lit(UNKNOWN))


def fare_per_mile(fare: Column, miles: Column) -> Column:
    """Fare per mile, 0 for a trip without distance."""
    return F.when(miles != 0, fare / miles).otherwise(F.lit(0.0))


def estimated_minutes(miles: Column) -> Column:
    """Duration of a trip that has not started, at the assumed average speed."""
    return miles / F.lit(ASSUMED_SPEED_MPH) * F.lit(60.0)
