"""Report tables as display text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import text
from tripflow.schemas import RECENT_TITLES, STATUS_IDLE, STATUS_LIVE


def kpi_display(summary: DataFrame) -> DataFrame:
    """Text of a ``kpi_summary`` row. Averages are null, not text, when there are no rides."""
    status = F.when(
        F.col("total_trips") > 0,
        F.concat(text.whole(F.col("total_trips")), F.lit(STATUS_LIVE)),
    ).otherwise(F.lit(STATUS_IDLE))
    return summary.select(
        text.whole(F.col("total_trips")).alias("total_trips"),
        text.money(F.col("total_revenue"), 0).alias("total_revenue"),
        text.money(F.col("average_fare")).alias("average_fare"),
        text.minutes(F.col("average_duration")).alias("average_duration"),
        text.miles(F.col("average_distance")).alias("average_distance"),
        status.alias("status"),
    )


def live_display(incoming: DataFrame) -> DataFrame:
    """Text of a ``live_incoming`` row."""
    return incoming.select(text.signed_whole(F.col("live_incoming")).alias("live_incoming"))


def tip_display(tip: DataFrame) -> DataFrame:
    """Text of an ``average_tip`` row."""
    return tip.select(text.money(F.col("average_tip")).alias("average_tip"))


def peak_hour_display(peak: DataFrame) -> DataFrame:
    """A ``peak_hour`` row with its hour as ``07:00``."""
    return peak.withColumn("hour_label", text.hour_label(F.col("pickup_hour")))


def payment_display(mix: DataFrame) -> DataFrame:
    """A ``payment_mix`` table with its shares as text."""
    return mix.withColumn("percent", text.percent(F.col("share")))


def smallest_first(top: DataFrame) -> DataFrame:
    """``top_pickup_zones`` turned round, as a bar chart lists them."""
    return top.orderBy("trips", F.desc("pickup_zone"))


def recent_rides_display(recent: DataFrame) -> DataFrame:
    """The five display columns of ``recent_rides``, in its order."""
    shown = recent.withColumns(
        {
            "pickup_datetime": text.time_label(F.col("pickup_datetime")),
            "trip_distance": text.miles(F.col("trip_distance")),
            "fare_amount": text.money(F.col("fare_amount")),
        }
    )
    return shown.select(*[F.col(name).alias(title) for name, title in RECENT_TITLES.items()])


def fare_card(scored: DataFrame) -> DataFrame:
    """Scored requests with the text of their result card."""
    return scored.withColumns(
        {
            "fare_text": text.money(F.col("predicted_fare")),
            "distance_text": text.miles(F.col("trip_distance"), 1),
            "per_mile_text": text.money(F.col("fare_per_mile")),
            "hour_text": text.hour_label(F.col("pickup_hour")),
        }
    )
