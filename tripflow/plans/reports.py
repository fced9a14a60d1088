"""The two report pages over rides, as named DataFrames of display text and numbers.

Each page takes rides or a ``ride_rollup`` of them. ``stored_rollup`` scans the rides once and
stores the few rows that all reports of both pages but the latest rides are then read from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripflow.operators import display, metrics
from tripflow.operators.rollup import ride_rollup


def stored_rollup(rides: DataFrame, folder: str) -> DataFrame:
    """Writes the rollup of the rides to a new folder and reads it back (runs a job)."""
    ride_rollup(rides).write.parquet(folder)
    return rides.sparkSession.read.parquet(folder)


def overview(rides: DataFrame, previous: DataFrame | None = None) -> dict[str, DataFrame]:
    """KPIs, and rides that came in since ``previous``."""
    return {
        "kpis": display.kpi_display(metrics.kpi_summary(rides)),
        "live": display.live_display(metrics.live_incoming(rides, previous)),
    }


def latest(
    rides: DataFrame, zones: DataFrame | None = None, key: tuple[str, ...] | None = None
) -> dict[str, DataFrame]:
    """The latest rides themselves; equal times by ``key``, or by all columns without one."""
    ties = key or tuple(name for name in rides.columns if name != "pickup_datetime")
    recent = metrics.recent_rides(rides, zones, tie_break=ties)
    return {"recent": display.recent_rides_display(recent)}


def analytics(rides: DataFrame, zones: DataFrame | None = None) -> dict[str, DataFrame]:
    """Peak hour, busiest zone, tips, hours, payment mix, top zones and boroughs.

    Without a zone dimension, boroughs are left out; zones are too if the rides have no names.
    """
    pages = {
        "peak_hour": display.peak_hour_display(metrics.peak_hour(rides)),
        "average_tip": display.tip_display(metrics.average_tip(rides)),
        "hours": metrics.trips_per_hour(rides),
        "payments": display.payment_display(metrics.payment_mix(rides)),
    }
    if zones is not None or "pickup_zone" in rides.columns:
        pages["busiest_zone"] = metrics.busiest_zone(rides, zones)
        pages["top_zones"] = display.smallest_first(metrics.top_pickup_zones(rides, zones))
    if zones is not None:
        pages["boroughs"] = metrics.trips_by_borough(rides, zones)
    return pages
