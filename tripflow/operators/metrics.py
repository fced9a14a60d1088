"""KPIs, breakdowns and top lists over rides.

All but the per-ride ones also take a ``ride_rollup`` in place of rides. Zone reports take rides
either with ``pickup_zone`` (the stored table) or, given the zone dimension, with
``pickup_location_id`` alone. In the second form trips are counted per id first and only those
few counts are joined to names, so no join touches the rides themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.trips import fare_per_mile
from tripflow.operators.rollup import average, total, trip_count
from tripflow.schemas import UNKNOWN


def kpi_summary(rides: DataFrame) -> DataFrame:
    """One row: trips, revenue and the three averages, in one pass over three columns."""
    return rides.agg(
        trip_count(rides).alias("total_trips"),
        F.coalesce(total(rides, "fare_amount"), F.lit(0.0)).alias("total_revenue"),
        average(rides, "fare_amount").alias("average_fare"),
        average(rides, "ride_duration_minutes").alias("average_duration"),
        average(rides, "trip_distance").alias("average_distance"),
    )


def average_tip(rides: DataFrame) -> DataFrame:
    return rides.agg(average(rides, "tip_amount").alias("average_tip"))


def live_incoming(current: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Rides that ``current`` has more than an earlier snapshot; 0 without one."""
    counts = current.agg(trip_count(current).alias("now"), F.lit(0).cast("bigint").alias("before"))
    if previous is None:
        counts = counts.withColumn("before", F.col("now"))
    else:
        earlier = previous.agg(
            F.lit(0).cast("bigint").alias("now"), trip_count(previous).alias("before")
        )
        counts = counts.unionByName(earlier).agg(
            F.sum("now").alias("now"), F.sum("before").alias("before")
        )
    added = F.greatest(F.col("now") - F.col("before"), F.lit(0).cast("bigint"))
    return counts.select(added.alias("live_incoming"))


def _trips_by_hour(rides: DataFrame) -> DataFrame:
    known = rides.filter(F.col("pickup_hour").isNotNull())
    return known.groupBy("pickup_hour").agg(trip_count(rides).alias("trips"))


def trips_per_hour(rides: DataFrame) -> DataFrame:
    return _trips_by_hour(rides).orderBy("pickup_hour")


def peak_hour(rides: DataFrame) -> DataFrame:
    """Busiest pickup hour; the lowest of equals. No row when there are no rides."""
    return _trips_by_hour(rides).orderBy(F.desc("trips"), "pickup_hour").limit(1)


def average_fare_by_hour(rides: DataFrame, top: int = 5) -> DataFrame:
    """The hours with the highest average fare, in SQL; equals by hour."""
    hours = rides.groupBy("pickup_hour").agg(average(rides, "fare_amount").alias("average_fare"))
    return rides.sparkSession.sql(
        """
        select pickup_hour, round(average_fare, 2) as avg_fare
        from {hours}
        order by avg_fare desc, pickup_hour
        limit :top
        """,
        args={"top": top},
        hours=hours,
    )


def payment_mix(rides: DataFrame) -> DataFrame:
    """Trips and share of trips per payment type, largest first; null types are left out.

    The total is a scalar subquery over the same grouped counts rather than a window without
    partitions: payment types come from dropped files, so their number has no bound.
    """
    known = rides.filter(F.col("payment_type").isNotNull())
    trips = known.groupBy("payment_type").agg(trip_count(rides).alias("trips"))
    all_trips = trips.agg(F.sum("trips")).scalar()
    return trips.withColumn("share", F.col("trips") / all_trips).orderBy(
        F.desc("trips"), "payment_type"
    )


def _trips_by_zone(rides: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Trips per pickup zone name, the null zone included."""
    if "pickup_zone" in rides.columns:
        return rides.groupBy("pickup_zone").agg(trip_count(rides).alias("trips"))
    if zones is None:
        raise ValueError("rides without pickup_zone need the zone dimension")
    per_id = rides.groupBy("pickup_location_id").agg(trip_count(rides).alias("trips"))
    names = zones.select(
        F.col("LocationID").cast("bigint").alias("pickup_location_id"),
        F.col("Zone").alias("pickup_zone"),
    )
    named = per_id.join(names, "pickup_location_id", "left")
    return named.groupBy("pickup_zone").agg(F.sum("trips").alias("trips"))


def trips_per_zone(rides: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    return _trips_by_zone(rides, zones).filter(F.col("pickup_zone").isNotNull())


def busiest_zone(rides: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Busiest pickup zone; the first name of equals. No row when no ride has a zone."""
    return top_pickup_zones(rides, zones, top=1)


def top_pickup_zones(
    rides: DataFrame, zones: DataFrame | None = None, top: int = 10
) -> DataFrame:
    """The busiest pickup zones, busiest first; equals by name."""
    ordered = trips_per_zone(rides, zones).orderBy(F.desc("trips"), "pickup_zone")
    return ordered.limit(top)


def zone_boroughs(zones: DataFrame) -> DataFrame:
    """One borough per zone name; names repeat in the dimension."""
    named = zones.filter(F.col("Zone").isNotNull())
    return named.groupBy(F.col("Zone").alias("pickup_zone")).agg(
        F.max("Borough").alias("borough")
    )


def trips_by_borough(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per borough of the pickup zone's name, "Unknown" included, largest first."""
    by_zone = _trips_by_zone(rides, zones).join(zone_boroughs(zones), "pickup_zone", "left")
    borough = F.coalesce("borough", F.lit(UNKNOWN))
    return (
        by_zone.groupBy(borough.alias("borough"))
        .agg(F.sum("trips").alias("trips"))
        .orderBy(F.desc("trips"), "borough")
    )


def zone_list(zones: DataFrame) -> DataFrame:
    """Zone names, sorted, each once."""
    names = zones.select("Zone").filter(F.col("Zone").isNotNull())
    return names.distinct().orderBy("Zone")


def recent_rides(
    rides: DataFrame,
    zones: DataFrame | None = None,
    top: int = 10,
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """The latest rides by pickup time.

    With ``zones``, the names are joined to the top rides only. The second limit holds should a
    zone id repeat in the dimension: every ride gives at least one row, so the first rows of all
    joined rides are among the joined first rides.
    """
    order = [F.desc("pickup_datetime"), *tie_break]
    latest = rides.orderBy(*order).limit(top)
    if zones is None:
        return latest
    for side in ("pickup", "dropoff"):
        names = zones.select(
            F.col("LocationID").cast("bigint").alias(f"{side}_location_id"),
            F.col("Zone").alias(f"{side}_zone"),
        )
        latest = latest.join(names, f"{side}_location_id", "left")
    return latest.orderBy(*order).limit(top)


def with_fare_per_mile(rides: DataFrame) -> DataFrame:
    per_mile = fare_per_mile(F.col("fare_amount"), F.col("trip_distance"))
    return rides.withColumn("fare_per_mile", per_mile)


def root_mean_squared_error(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE of a scored table as one row."""
    error = F.col(label) - F.col(prediction)
    return scored.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def mean_predictor_rmse(rides: DataFrame, split: str = "split") -> DataFrame:
    """Error on the test part of always predicting the train part's mean fare.

    Both parts are summed up in one pass: the squared error about the train mean follows from
    the test part's variance and mean, so the mean needs no second scan.
    """
    fare = F.col("fare_amount")
    train = F.when(F.col(split) == "train", fare)
    test = F.when(F.col(split) == "test", fare)
    parts = rides.agg(
        F.avg(train).alias("train_mean"),
        F.avg(test).alias("test_mean"),
        F.var_pop(test).alias("test_variance"),
        F.count(test).alias("test_rows"),
    )
    bias = F.col("test_mean") - F.col("train_mean")
    return parts.select("test_rows", F.sqrt(F.col("test_variance") + bias * bias).alias("rmse"))
