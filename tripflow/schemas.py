"""Shapes of the tables this package reads and writes, and the constants that go with them.

Schemas are kept as plain ``{column: SQL type}`` maps, because ``StructType.fromDDL`` needs a
running session and these are needed at import time; ``ddl`` turns one into the text every
Spark reader accepts.
"""

from __future__ import annotations

from tripflow.functions.exact import SUM_TYPE

# --- Fixed values: names, types, codes and constants that files and results depend on ---------

TRIP_RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

TRIP = {
    "trip_id": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "trip_distance": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "passenger_count": "bigint",
    "payment_type": "bigint",
}

FEED = {
    "pickup_datetime": "string",
    "dropoff_datetime": "string",
    "trip_distance": "double",
    "pickup_location_id": "bigint",
    "dropoff_location_id": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "passenger_count": "bigint",
    "payment_type": "string",
}

ZONES = {
    "LocationID": "int",
    "Borough": "string",
    "Zone": "string",
    "service_zone": "string",
}

PAYMENT_LABELS = {
    1: "Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}

#: Column types of feed files, as Arrow names them, that can stand for a declared type.
FEED_FILE_TYPES = {
    "string": {"string", "large_string", "timestamp[us]", "timestamp[ms]", "timestamp[ns]"},
    "double": {"double", "float", "int64", "int32"},
    "bigint": {"int64", "int32", "int16", "double"},
}

UNKNOWN = "Unknown"
DEFAULT_TIP = 0.0
DEFAULT_PASSENGERS = 1

ASSUMED_SPEED_MPH = 15.0

REQUEST_RANGES = {
    "trip_distance": (0.1, 100.0),
    "passenger_count": (1, 6),
    "pickup_hour": (0, 23),
}

NUMERIC_FEATURES = ["trip_distance", "pickup_hour", "passenger_count", "ride_duration_minutes"]
ZONE_FEATURES = ["pickup_zone", "dropoff_zone"]
LABEL = "fare_amount"
PREDICTION = "predicted_fare"

FOREST_TREES = 50
FOREST_DEPTH = 8
FOREST_BINS = 300
RECENT_TITLES = {
    "pickup_datetime": "Pickup Time",
    "pickup_zone": "From",
    "dropoff_zone": "To",
    "trip_distance": "Distance",
    "fare_amount": "Fare",
}

TIME_FORMAT = "MMM dd, HH:mm"
HOUR_FORMAT = "%02d:00"
STATUS_LIVE = " rides processed"
STATUS_IDLE = "Waiting for rides…"

SEED = 42
TRAIN_PERCENT = 80
TRAINING_SAMPLE_ROWS = 200_000

#: Bins of a forest that zones without a bin of their own share, where there are too many zones.
SHARED_ZONE_BINS = 32

# --- Derived shapes ---------------------------------------------------------------------------

RIDES = {
    **FEED,
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "ride_duration_minutes": "double",
    "pickup_hour": "int",
    "pickup_zone": "string",
    "dropoff_zone": "string",
}

MEASURES = ["fare_amount", "ride_duration_minutes", "trip_distance", "tip_amount"]

#: The text of a CSV record that does not fit the feed's types.
RECORD = "record"

REJECTS = {**FEED, RECORD: "string", "reason": "string"}

BATCH_COUNTS = {"arrived": "bigint", "kept": "bigint", "rejected": "bigint"}

DEAD_LETTERS = {"path": "string", "reason": "string"}

ROLLUP = {
    "pickup_zone": "string",
    "pickup_hour": "int",
    "payment_type": "string",
    "trips": "bigint",
    **{f"{name}_sum": SUM_TYPE for name in MEASURES},
    **{f"{name}_count": "bigint" for name in MEASURES},
}

REQUESTS = {
    "trip_distance": "double",
    "passenger_count": "bigint",
    "pickup_hour": "int",
    "pickup_zone": "string",
    "dropoff_zone": "string",
}


def ddl(columns: dict[str, str]) -> str:
    """The schema text of a ``{column: SQL type}`` map."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
