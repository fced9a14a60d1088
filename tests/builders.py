"""Small hand-written tables."""

from __future__ import annotations

from datetime import datetime

from tripflow.schemas import FEED, RIDES, ZONES, ddl

GOOD = {
    "pickup_datetime": "2020-01-01 10:00:00",
    "dropoff_datetime": "2020-01-01 10:20:00",
    "trip_distance": 3.0,
    "pickup_location_id": 1,
    "dropoff_location_id": 2,
    "fare_amount": 15.0,
    "tip_amount": 2.0,
    "passenger_count": 1,
    "payment_type": "Card",
}

ZONE_ROWS = [
    (1, "North", "Alpha", "Yellow"),
    (2, "South", "Beta", "Yellow"),
    (3, "North", "Gamma", "Green"),
    (4, "North", "Gamma", "Green"),
    (5, "Unknown", "NA", "N/A"),
    (6, "South", None, "N/A"),
]


def feed(spark, *changes: dict):
    """A feed with one row per change to the good ride."""
    rows = [tuple({**GOOD, **change}[name] for name in FEED) for change in changes]
    return spark.createDataFrame(rows, ddl(FEED))


def zones(spark):
    return spark.createDataFrame(ZONE_ROWS, ddl(ZONES))


def rides(spark, *changes: dict):
    """Stored rides, zone names included."""
    good = {
        **GOOD,
        "pickup_datetime": datetime(2020, 1, 1, 10),
        "dropoff_datetime": datetime(2020, 1, 1, 10, 20),
        "ride_duration_minutes": 20.0,
        "pickup_hour": 10,
        "pickup_zone": "Alpha",
        "dropoff_zone": "Beta",
    }
    rows = [tuple({**good, **change}[name] for name in RIDES) for change in changes]
    return spark.createDataFrame(rows, ddl(RIDES))
