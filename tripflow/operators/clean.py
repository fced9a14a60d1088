"""Validity rules and derived columns of a ride.

The cheap comparisons come first and on bare columns, so that they reach the Parquet scan; the
rules on parsed times follow. Zone names are left to ``enrich``: most reports do not need them.

Times are parsed through ``inline``. Catalyst would otherwise push the filters on parsed times
below the projection that parses them, and parse both texts again in every filter; it does not
push filters through a generator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.trips import duration_minutes, parse_time, pickup_hour
from tripflow.schemas import RECORD

TIMES = ["pickup_datetime", "dropoff_datetime"]
CORE = [*TIMES, "fare_amount", "trip_distance"]


def drop_missing(feed: DataFrame) -> DataFrame:
    """Drops rows with a null or NaN time, fare or distance."""
    return feed.dropna(subset=CORE)


def positive_fare(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("fare_amount") > 0)


def positive_distance(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("trip_distance") > 0)


def parse_times(feed: DataFrame) -> DataFrame:
    """Parses both times and drops rows where either is missing or does not parse."""
    once = F.struct(*[parse_time(F.col(name)).alias(f"_{name}") for name in TIMES])
    parsed = feed.select("*", F.inline(F.array(once))).dropna(subset=[f"_{n}" for n in TIMES])
    return parsed.select(
        *[F.col(f"_{name}").alias(name) if name in TIMES else name for name in feed.columns]
    )


def with_duration(rides: DataFrame) -> DataFrame:
    """Adds ``ride_duration_minutes`` and keeps rides that took time."""
    minutes = duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return rides.withColumn("ride_duration_minutes", minutes).filter("ride_duration_minutes > 0")


def with_pickup_hour(rides: DataFrame) -> DataFrame:
    return rides.withColumn("pickup_hour", pickup_hour(F.col("pickup_datetime")))


def clean(feed: DataFrame) -> DataFrame:
    """Valid rides with duration and hour, still keyed by zone id.

    A missing time needs no check of its own: it does not parse.
    """
    priced = feed.dropna(subset=["fare_amount", "trip_distance"])
    valid = positive_distance(positive_fare(priced))
    return with_pickup_hour(with_duration(parse_times(valid)))


def judged(feed: DataFrame, *more: str) -> DataFrame:
    """Feed rows with both times parsed beside them and ``reason``: the first rule a row fails.

    ``reason`` is null for the rows that ``clean`` keeps. A row with the text of a record that did
    not fit its file's types is rejected for that. ``more`` names columns of the feed to
    keep besides those that the rules read; all of them unless given.
    """
    times = F.struct(*[parse_time(F.col(name)).alias(f"_{name}") for name in TIMES])
    kept = dict.fromkeys([*CORE, *more]) if more else feed.columns
    rows = feed.select(*kept, F.inline(F.array(times)))
    pickup, dropoff = (F.col(f"_{name}") for name in TIMES)
    missing = F.col(TIMES[0]).isNull() | F.col(TIMES[1]).isNull()
    for name in ("fare_amount", "trip_distance"):
        missing = missing | F.col(name).isNull() | F.isnan(name)
    rules = F
    if RECORD in kept:
        rules = F.when(F.col(RECORD).isNotNull(), "record not readable")
    reason = (
        rules.when(missing, "missing value")
        .when(F.col("fare_amount") <= 0, "fare not positive")
        .when(F.col("trip_distance") <= 0, "distance not positive")
        .when(pickup.isNull() | dropoff.isNull(), "time not readable")
        .when(duration_minutes(pickup, dropoff) <= 0, "duration not positive")
    )
    return rows.withColumn("reason", reason)


def kept_rides(rows: DataFrame) -> DataFrame:
    """The rides among ``judged`` rows: what ``clean`` makes of the same feed."""
    others = {"reason", RECORD, *[f"_{name}" for name in TIMES]}
    feed = [name for name in rows.columns if name not in others]
    timed = rows.filter("reason is null").select(
        *[F.col(f"_{name}").alias(name) if name in TIMES else name for name in feed]
    )
    minutes = duration_minutes(F.col(TIMES[0]), F.col(TIMES[1]))
    return with_pickup_hour(timed.withColumn("ride_duration_minutes", minutes))


def rejected_rows(rows: DataFrame) -> DataFrame:
    """The others among ``judged`` rows, as they came, with their reason."""
    return rows.filter("reason is not null").drop(*[f"_{name}" for name in TIMES])


def reject_reasons(feed: DataFrame) -> DataFrame:
    """How many rows ``clean`` drops, by the first rule each one fails."""
    rejected = judged(feed, *CORE).filter("reason is not null")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("trips"))
