"""Fare requests: rides that have not started."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.trips import estimated_minutes
from tripflow.schemas import REQUEST_RANGES, REQUESTS


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests within the ranges that are offered; a missing value is not within any."""
    rules = [F.col(name).between(*ends) for name, ends in REQUEST_RANGES.items()]
    return requests.filter(reduce(and_, rules))


def rejected_requests(requests: DataFrame) -> DataFrame:
    """The other requests, each with the names of the columns out of range, comma-joined."""
    wrong = [
        F.when(F.coalesce(F.col(name).between(*ends), F.lit(False)), None).otherwise(name)
        for name, ends in REQUEST_RANGES.items()
    ]
    return requests.withColumn("reason", F.concat_ws(",", *wrong)).filter("reason <> ''")


def request_features(requests: DataFrame) -> DataFrame:
    """Requests with their columns cast and a duration at the assumed speed."""
    typed = requests.withColumns(
        {name: F.col(name).try_cast(kind) for name, kind in REQUESTS.items()}
    )
    return typed.withColumn("ride_duration_minutes", estimated_minutes(F.col("trip_distance")))
