"""Trips, zones and requests derived from the ``events``, ``nation`` and ``region`` tables.

Every event becomes a trip. The derivation plants dirt on purpose: negative, null and NaN fares,
zero distances, durations that are not positive, null and unmatched ids, null and unlisted
payment codes, null tips and passengers, and time text that does not parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.clean import clean
from tripflow.operators.enrich import enrich
from tripflow.operators.normalize import normalize_feed
from tripflow.sources.files import read_trips

KEY = ("trip_id",)

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"

TRIP_OF_EVENT = [
    "event_id as trip_id",
    "ts as tpep_pickup_datetime",
    "ts + make_dt_interval(0, 0, cast(event_id % 60 - 5 as int), 0) as tpep_dropoff_datetime",
    "cast((event_id * 7) % 200 as double) / 10 as trip_distance",
    "if(event_id % 89 = 0, null, user_id % 27) as PULocationID",
    "(event_id * 13) % 27 as DOLocationID",
    """case when event_id % 50 = 0 then -value
            when event_id % 53 = 0 then null
            when event_id % 101 = 0 then double('NaN')
            else value end as fare_amount""",
    "if(event_id % 11 = 0, null, value * double(0.125)) as tip_amount",
    "if(event_id % 17 = 0, null, event_id % 6 + 1) as passenger_count",
    "if(event_id % 19 = 0, null, event_id % 8) as payment_type",
]

REQUEST_OF_EVENT = [
    "event_id as request_id",
    "cast((event_id * 7) % 1100 as double) / 10 as trip_distance",
    "event_id % 8 as passenger_count",
    "int(event_id % 26) as pickup_hour",
    "user_id % 27 as pickup_location_id",
    "(event_id * 13) % 27 as dropoff_location_id",
]


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_trips(spark, f"{folder}/events.parquet", schema=EVENTS)


def trips_of(events: DataFrame) -> DataFrame:
    """Raw trips of a batch or a stream of events."""
    return events.selectExpr(*TRIP_OF_EVENT)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_of(events(spark, folder))


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    nation = spark.read.schema(NATION).parquet(f"{folder}/nation.parquet")
    region = spark.read.schema(REGION).parquet(f"{folder}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey as LocationID",
        "r_name as Borough",
        "n_name as Zone",
        "concat(r_name, ' Zone') as service_zone",
    )


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed rows, keyed by trip, with some pickup times unreadable."""
    rows = normalize_feed(trips(spark, folder), key=KEY)
    return rows.withColumn(
        "pickup_datetime", F.expr("if(trip_id % 97 = 0, 'NaT', pickup_datetime)")
    )


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """Clean rides, keyed by trip and zone id, without zone names."""
    return clean(feed(spark, folder))


def named_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Clean rides with zone names."""
    return enrich(rides(spark, folder), zones(spark, folder))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """A fare request per event; some distances, passenger counts and hours are out of range."""
    asked = events(spark, folder).selectExpr(*REQUEST_OF_EVENT)
    return enrich(asked, zones(spark, folder)).drop("pickup_location_id", "dropoff_location_id")
