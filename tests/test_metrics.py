from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.builders import rides, zones
from tripflow.functions import text
from tripflow.functions.trips import estimated_minutes
from tripflow.operators import display, metrics
from tripflow.operators.requests import request_features, valid_requests
from tripflow.schemas import REQUESTS, ddl


def values(frame):
    return [tuple(row) for row in frame.collect()]


@pytest.fixture(scope="module")
def table(spark):
    return rides(
        spark,
        {"pickup_hour": 9, "fare_amount": 10.0, "payment_type": "Cash"},
        {"pickup_hour": 9, "fare_amount": 20.0, "pickup_zone": "Beta"},
        {"pickup_hour": 7, "fare_amount": 30.0, "pickup_zone": "Beta", "tip_amount": None},
        {"pickup_hour": 7, "fare_amount": 1000.0, "pickup_zone": None, "payment_type": None},
        {"pickup_hour": 3, "fare_amount": 5.0, "pickup_zone": "Nowhere"},
    )


@pytest.fixture(scope="module")
def empty(table):
    return table.filter("false")


def test_kpis(table, empty):
    assert values(metrics.kpi_summary(table)) == [(5, 1065.0, 213.0, 20.0, 3.0)]
    assert values(metrics.kpi_summary(empty)) == [(0, 0.0, None, None, None)]
    assert values(metrics.average_tip(table)) == [(2.0,)]


def test_kpi_text(table, empty):
    assert values(display.kpi_display(metrics.kpi_summary(table))) == [
        ("5", "$1,065", "$213.00", "20.0 min", "3.00 mi", "5 rides processed")
    ]
    assert values(display.kpi_display(metrics.kpi_summary(empty))) == [
        ("0", "$0", None, None, None, "Waiting for rides…")
    ]


def test_live_incoming(table, empty):
    assert values(metrics.live_incoming(table)) == [(0,)]
    assert values(metrics.live_incoming(table, table.limit(2))) == [(3,)]
    assert values(metrics.live_incoming(empty, table)) == [(0,)]
    assert values(display.live_display(metrics.live_incoming(table, empty))) == [("+5",)]


def test_hours(table, empty):
    assert values(metrics.trips_per_hour(table)) == [(3, 1), (7, 2), (9, 2)]
    assert values(display.peak_hour_display(metrics.peak_hour(table))) == [(7, 2, "07:00")]
    assert values(metrics.peak_hour(empty)) == []


def test_average_fare_by_hour(table):
    assert values(metrics.average_fare_by_hour(table, top=2)) == [(7, 515.0), (9, 15.0)]


def test_payment_mix_leaves_out_nulls(table):
    mix = metrics.payment_mix(table)
    assert values(mix) == [("Card", 3, 0.75), ("Cash", 1, 0.25)]
    assert [row.percent for row in display.payment_display(mix).collect()] == ["75.0%", "25.0%"]


def test_zone_reports(table, empty, spark):
    counts = [("Alpha", 1), ("Beta", 2), ("Nowhere", 1)]
    assert sorted(values(metrics.trips_per_zone(table))) == counts
    assert values(metrics.busiest_zone(table)) == [("Beta", 2)]
    assert values(metrics.top_pickup_zones(table, top=2)) == [("Beta", 2), ("Alpha", 1)]
    top = metrics.top_pickup_zones(table)
    assert values(display.smallest_first(top)) == values(top)[::-1]
    assert values(metrics.busiest_zone(empty)) == []
    assert values(metrics.trips_by_borough(table, zones(spark))) == [
        ("South", 2),
        ("Unknown", 2),
        ("North", 1),
    ]


def test_zone_reports_by_id_equal_those_by_name(spark):
    named = rides(
        spark,
        {"pickup_location_id": 3, "pickup_zone": "Gamma"},
        {"pickup_location_id": 4, "pickup_zone": "Gamma"},
        {"pickup_location_id": 2, "pickup_zone": "Beta"},
        {"pickup_location_id": 6, "pickup_zone": None},
        {"pickup_location_id": 77, "pickup_zone": None},
        {"pickup_location_id": None, "pickup_zone": None},
    )
    by_id = named.drop("pickup_zone", "dropoff_zone")
    dimension = zones(spark)
    for report in (metrics.trips_per_zone, metrics.top_pickup_zones, metrics.trips_by_borough):
        assert sorted(values(report(by_id, dimension))) == sorted(values(report(named, dimension)))
    with pytest.raises(ValueError, match="zone dimension"):
        metrics.trips_per_zone(by_id)


def test_zone_list_is_sorted_distinct_and_without_nulls(spark):
    assert values(metrics.zone_list(zones(spark))) == [("Alpha",), ("Beta",), ("Gamma",), ("NA",)]


def test_recent_rides(spark):
    table = rides(
        spark,
        *[
            {"pickup_datetime": datetime(2024, 1, 5, 9, minute), "fare_amount": float(minute + 1)}
            for minute in range(12)
        ],
    )
    recent = metrics.recent_rides(table)
    assert [row.fare_amount for row in recent.collect()] == [float(n) for n in range(12, 2, -1)]
    late = metrics.recent_rides(table.drop("pickup_zone", "dropoff_zone"), zones(spark), top=1)
    shown = display.recent_rides_display(late)
    assert shown.columns == ["Pickup Time", "From", "To", "Distance", "Fare"]
    assert values(shown) == [("Jan 05, 09:11", "Alpha", "Beta", "3.00 mi", "$12.00")]


def test_recent_rides_with_repeated_zone_ids_still_gives_ten(spark):
    table = rides(spark, *[{"pickup_datetime": datetime(2024, 1, 1, 0, n)} for n in range(12)])
    twice = zones(spark).union(zones(spark))
    plain = table.drop("pickup_zone", "dropoff_zone")
    assert metrics.recent_rides(plain, twice).count() == 10


@pytest.mark.parametrize("number", [0.125, 0.375, 2.675, 1234.565, 0.5, 1.5, 2.5, 999999.995])
def test_numbers_round_as_python_formats_them(spark, number):
    value = F.lit(number)
    shown = (
        spark.range(1)
        .select(text.money(value), text.money(value, 0), text.miles(value), text.minutes(value))
        .first()
    )
    assert tuple(shown) == (
        f"${number:,.2f}",
        f"${number:,.0f}",
        f"{number:.2f} mi",
        f"{number:.1f} min",
    )


def test_fare_per_mile_of_no_distance_is_zero(spark):
    schema = "fare_amount double, trip_distance double"
    frame = metrics.with_fare_per_mile(spark.createDataFrame([(10.0, 4.0), (10.0, 0.0)], schema))
    assert [row.fare_per_mile for row in frame.collect()] == [2.5, 0.0]


def test_rmse(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], "y double, p double")
    assert metrics.root_mean_squared_error(frame, "y", "p").first().rmse == pytest.approx(5**0.5)
    parts = [("train", 2.0), ("train", 4.0), ("test", 1.0), ("test", 7.0)]
    split = spark.createDataFrame(parts, "split string, fare_amount double")
    row = metrics.mean_predictor_rmse(split).first()
    assert (row.test_rows, row.rmse) == (2, pytest.approx(10**0.5))


def test_requests(spark):
    rows = [
        (3.0, 1, 12, "Alpha", "Beta"),
        (0.1, 6, 23, None, "Beta"),
        (100.0, 1, 0, "Alpha", "Beta"),
        (0.0, 1, 12, "Alpha", "Beta"),
        (100.1, 1, 12, "Alpha", "Beta"),
        (3.0, 0, 12, "Alpha", "Beta"),
        (3.0, 7, 12, "Alpha", "Beta"),
        (3.0, 1, 24, "Alpha", "Beta"),
        (None, 1, 12, "Alpha", "Beta"),
    ]
    requests = spark.createDataFrame(rows, ddl(REQUESTS))
    assert values(valid_requests(requests)) == rows[:3]
    features = request_features(requests).collect()
    assert [row.ride_duration_minutes for row in features][:1] == [12.0]
    assert spark.range(1).select(estimated_minutes(F.lit(30.0))).first()[0] == 120.0
