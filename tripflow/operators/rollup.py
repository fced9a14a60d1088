"""Rides summed up per zone, hour and payment type.

Every report but the latest rides follows from these few rows, so a page of reports costs one
scan of the rides instead of one per report. The reports of ``metrics`` take either form; the
helpers here give them the expression for the form at hand. Sums are kept in parts that add up
exactly, so both forms give the same doubles, however the rows lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.exact import exact_sum, merged_sum, sum_value
from tripflow.schemas import MEASURES

GROUPS = ("pickup_location_id", "pickup_zone", "pickup_hour", "payment_type")


def ride_rollup(rides: DataFrame) -> DataFrame:
    """Trips, and the sum (in parts) and count of each measure, per group.

    Rides with ``pickup_zone`` are grouped by it, others by zone id.
    """
    names = [name for name in GROUPS if name in rides.columns]
    if "pickup_zone" in names:
        names.remove("pickup_location_id")
    sums = [exact_sum(name).alias(f"{name}_sum") for name in MEASURES]
    counts = [F.count(name).alias(f"{name}_count") for name in MEASURES]
    return rides.groupBy(*names).agg(F.count(F.lit(1)).alias("trips"), *sums, *counts)


def is_rollup(rows: DataFrame) -> bool:
    return "trips" in rows.columns


def trip_count(rows: DataFrame) -> Column:
    """Number of rides; 0 without any."""
    if is_rollup(rows):
        return F.coalesce(F.sum("trips"), F.lit(0).cast("bigint"))
    return F.count(F.lit(1))


def total(rows: DataFrame, name: str) -> Column:
    """Sum of a measure; null without any."""
    return sum_value(merged_sum(f"{name}_sum") if is_rollup(rows) else exact_sum(name))


def average(rows: DataFrame, name: str) -> Column:
    """Mean of a measure's known values; null without any."""
    known = F.sum(f"{name}_count") if is_rollup(rows) else F.count(name)
    return F.try_divide(total(rows, name), known)
