"""Raw trip columns to feed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.trips import payment_label
from tripflow.schemas import DEFAULT_PASSENGERS, DEFAULT_TIP, FEED, TRIP_RENAMES, UNKNOWN

NUMBERS = ("trip_distance", "pickup_location_id", "dropoff_location_id", "fare_amount")
DEFAULTS = {"tip_amount": DEFAULT_TIP, "passenger_count": DEFAULT_PASSENGERS}
OPTIONAL = (*DEFAULTS, "payment_type")


def rename_trips(trips: DataFrame) -> DataFrame:
    """Gives the historical columns their feed names; absent ones are skipped."""
    return trips.withColumnsRenamed(TRIP_RENAMES)


def keep_feed_columns(trips: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """Keeps the feed columns that exist, after any ``key`` columns the caller wants to carry."""
    return trips.select(*key, *[name for name in FEED if name in trips.columns])


def _renamed(trips: DataFrame, key: tuple[str, ...]) -> DataFrame:
    renamed = keep_feed_columns(rename_trips(trips), key)
    required = [name for name in FEED if name not in OPTIONAL and name not in renamed.columns]
    if required:
        raise ValueError(f"trips lack required columns: {', '.join(required)}")
    return renamed


def _missing(trips: DataFrame, name: str) -> str:
    """Null, or NaN in a floating-point column."""
    if trips.schema[name].dataType.typeName() in ("float", "double"):
        return f"{name} is null or isnan({name})"
    return f"{name} is null"


def _well_formed(trips: DataFrame) -> str:
    """True for rows whose numbers can all be coerced, false for the others.

    Ids, fare and distance must be there; a missing optional value takes its default, but one
    that is there and cannot be coerced spoils the row.
    """
    rules = [f"try_cast({name} as {FEED[name]}) is not null" for name in NUMBERS]
    coerced = {**FEED, "payment_type": "bigint"}
    rules += [
        f"({_missing(trips, name)} or try_cast({name} as {coerced[name]}) is not null)"
        for name in OPTIONAL
        if name in trips.columns
    ]
    return " and ".join(rules)


def normalize_feed(trips: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """Feed rows of raw trips: renamed, coerced, defaulted, malformed rows left out."""
    raw = _renamed(trips, key)
    values = {name: f"try_cast({name} as {kind})" for name, kind in FEED.items()}
    for name, default in DEFAULTS.items():
        if name in raw.columns:
            values[name] = f"if({_missing(raw, name)}, {FEED[name]}({default}), {values[name]})"
        else:
            values[name] = f"{FEED[name]}({default})"
    columns = {name: F.expr(value).alias(name) for name, value in values.items()}
    if "payment_type" in raw.columns:
        columns["payment_type"] = payment_label(F.col("payment_type")).alias("payment_type")
    else:
        columns["payment_type"] = F.lit(UNKNOWN).alias("payment_type")
    return raw.filter(_well_formed(raw)).select(*key, *columns.values())


def malformed_rows(trips: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """The raw rows that ``normalize_feed`` leaves out, with their values as they were."""
    raw = _renamed(trips, key)
    return raw.filter(f"not ({_well_formed(raw)})")


def label_payments(trips: DataFrame) -> DataFrame:
    """Payment codes replaced by their labels."""
    return trips.withColumn("payment_type", payment_label(F.col("payment_type")))
