from datetime import datetime

import pytest

from tests.builders import feed, zones
from tripflow.operators.clean import clean, parse_times, reject_reasons
from tripflow.operators.enrich import enrich
from tripflow.schemas import RIDES

NAN = float("nan")

BAD = [
    ({"pickup_datetime": None}, "missing value"),
    ({"dropoff_datetime": None}, "missing value"),
    ({"fare_amount": None}, "missing value"),
    ({"fare_amount": NAN}, "missing value"),
    ({"trip_distance": None}, "missing value"),
    ({"trip_distance": NAN}, "missing value"),
    ({"fare_amount": 0.0}, "fare not positive"),
    ({"fare_amount": -5.0}, "fare not positive"),
    ({"trip_distance": 0.0}, "distance not positive"),
    ({"trip_distance": -1.0}, "distance not positive"),
    ({"pickup_datetime": ""}, "time not readable"),
    ({"pickup_datetime": "NaT"}, "time not readable"),
    ({"dropoff_datetime": "2020-13-45"}, "time not readable"),
    ({"dropoff_datetime": "2020-01-01 10:00:00"}, "duration not positive"),
    ({"dropoff_datetime": "2020-01-01 09:59:59"}, "duration not positive"),
    ({"dropoff_datetime": "2020-01-01 10:00:00.9"}, "duration not positive"),
]


def test_good_ride_stays_and_negative_fare_goes(spark):
    other = {
        "pickup_datetime": "2020-01-01 11:00:00",
        "dropoff_datetime": "2020-01-01 11:10:00",
        "trip_distance": 2.0,
        "fare_amount": -5.0,
        "tip_amount": 0.0,
        "payment_type": "Cash",
    }
    kept = enrich(clean(feed(spark, {}, other)), zones(spark))
    (ride,) = kept.collect()
    assert ride.ride_duration_minutes == 20.0
    assert ride.pickup_hour == 10
    assert (ride.pickup_zone, ride.dropoff_zone) == ("Alpha", "Beta")
    assert dict(kept.dtypes) == RIDES
    assert kept.columns[:2] == ["dropoff_location_id", "pickup_location_id"]


@pytest.mark.parametrize(("change", "reason"), BAD)
def test_bad_rides_go_and_their_reason_is_counted(spark, change, reason):
    bad = feed(spark, change)
    assert clean(bad).count() == 0
    assert [tuple(row) for row in reject_reasons(bad).collect()] == [(reason, 1)]


def test_reasons_account_for_every_dropped_row(spark):
    rows = feed(spark, {}, {"pickup_location_id": None}, *[change for change, _ in BAD])
    dropped = sum(row.trips for row in reject_reasons(rows).collect())
    assert clean(rows).count() == 2
    assert dropped == len(BAD)


def test_each_side_is_cut_to_the_second_before_the_difference(spark):
    times = {
        "pickup_datetime": "2020-01-01 10:00:00.9",
        "dropoff_datetime": "2020-01-01 12:00:00.1",
    }
    assert clean(feed(spark, times)).first().ride_duration_minutes == 120.0


def test_date_only_text_is_midnight(spark):
    row = clean(feed(spark, {"pickup_datetime": "2020-01-01"})).first()
    assert row.pickup_datetime == datetime(2020, 1, 1)
    assert row.pickup_hour == 0


def test_typed_times_are_accepted(spark):
    typed = feed(spark, {}).selectExpr(
        "* except (pickup_datetime, dropoff_datetime)",
        "cast(pickup_datetime as timestamp_ntz) as pickup_datetime",
        "cast(dropoff_datetime as timestamp) as dropoff_datetime",
    )
    assert clean(typed).first().ride_duration_minutes == 20.0


def test_durations_do_not_depend_on_the_session_time_zone(spark):
    # New York clocks skip an hour within this ride.
    times = {"pickup_datetime": "2024-03-10 01:30:00", "dropoff_datetime": "2024-03-10 03:30:00"}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = clean(feed(spark, times)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.ride_duration_minutes, row.pickup_hour) == (120.0, 1)


def test_parse_times_keeps_the_column_order(spark):
    rows = feed(spark, {})
    assert parse_times(rows).columns == rows.columns


def test_empty_feed(spark):
    empty = feed(spark, {}).filter("false")
    assert clean(empty).count() == 0
    assert reject_reasons(empty).count() == 0
