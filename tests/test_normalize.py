from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripflow.operators.normalize import (
    keep_feed_columns,
    label_payments,
    malformed_rows,
    normalize_feed,
    rename_trips,
)
from tripflow.schemas import FEED

RAW = (
    "id int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "trip_distance double, PULocationID double, DOLocationID bigint, fare_amount double, "
    "tip_amount double, passenger_count double, payment_type double, extra string"
)
NAN = float("nan")


def raw(spark, **changes):
    row = {
        "id": 1,
        "tpep_pickup_datetime": datetime(2024, 1, 5, 9, 7, 3, 500000),
        "tpep_dropoff_datetime": datetime(2024, 1, 5, 9, 30),
        "trip_distance": 2.5,
        "PULocationID": 7.0,
        "DOLocationID": 8,
        "fare_amount": 12.0,
        "tip_amount": 1.0,
        "passenger_count": 2.0,
        "payment_type": 1.0,
        "extra": "x",
        **changes,
    }
    return spark.createDataFrame([tuple(row.values())], RAW)


def test_types_names_and_text_times(spark):
    feed = normalize_feed(raw(spark))
    assert feed.dtypes == list(FEED.items())
    row = feed.first()
    assert row.pickup_datetime == "2024-01-05 09:07:03.5"
    assert (row.pickup_location_id, row.passenger_count, row.payment_type) == (7, 2, "Card")


@pytest.mark.parametrize(
    ("code", "label"),
    [
        (1.0, "Card"),
        (2.0, "Cash"),
        (3.0, "No Charge"),
        (4.0, "Dispute"),
        (5.0, "Unknown"),
        (6.0, "Voided"),
        (0.0, "Unknown"),
        (9.0, "Unknown"),
        (1.9, "Card"),
        (None, "Unknown"),
        (NAN, "Unknown"),
    ],
)
def test_payment_codes(spark, code, label):
    trips = raw(spark, payment_type=code)
    assert normalize_feed(trips).first().payment_type == label
    assert label_payments(trips).first().payment_type == label


@pytest.mark.parametrize("missing", [None, NAN])
def test_missing_optional_values_take_defaults(spark, missing):
    row = normalize_feed(raw(spark, tip_amount=missing, passenger_count=missing)).first()
    assert (row.tip_amount, row.passenger_count) == (0.0, 1)


@pytest.mark.parametrize("column", ["PULocationID", "fare_amount", "trip_distance"])
def test_missing_required_number_rejects_the_row(spark, column):
    trips = raw(spark, **{column: None})
    assert normalize_feed(trips).count() == 0
    assert malformed_rows(trips, key=("id",)).first().id == 1


def test_nan_id_rejects_but_nan_fare_is_left_to_cleaning(spark):
    assert normalize_feed(raw(spark, PULocationID=NAN)).count() == 0
    assert normalize_feed(raw(spark, fare_amount=NAN)).count() == 1


@pytest.mark.parametrize("column", ["tip_amount", "passenger_count", "payment_type"])
def test_unreadable_optional_text_rejects_the_row(spark, column):
    trips = raw(spark).withColumn(column, F.lit("abc"))
    assert normalize_feed(trips).count() == 0
    assert malformed_rows(trips).count() == 1


def test_absent_optional_columns_take_defaults(spark):
    row = normalize_feed(raw(spark).drop("tip_amount", "passenger_count", "payment_type")).first()
    assert (row.tip_amount, row.passenger_count, row.payment_type) == (0.0, 1, "Unknown")


def test_absent_required_column_is_an_error(spark):
    with pytest.raises(ValueError, match="dropoff_location_id"):
        normalize_feed(raw(spark).drop("DOLocationID"))


def test_missing_time_stays_null(spark):
    assert normalize_feed(raw(spark, tpep_pickup_datetime=None)).first().pickup_datetime is None


def test_every_row_is_either_fed_or_malformed(spark):
    trips = raw(spark).union(raw(spark, PULocationID=None)).union(raw(spark, tip_amount=None))
    assert normalize_feed(trips).count() + malformed_rows(trips).count() == 3


def test_rename_and_keep_skip_absent_columns(spark):
    trips = raw(spark).drop("tpep_dropoff_datetime", "tip_amount")
    kept = keep_feed_columns(rename_trips(trips), key=("id",))
    assert kept.columns == [
        "id",
        *[name for name in FEED if name not in ("dropoff_datetime", "tip_amount")],
    ]
