"""Random rows through the operators against the same rules in plain Python."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tests.builders import ZONE_ROWS, zones
from tripflow.operators import metrics
from tripflow.operators.clean import clean, reject_reasons
from tripflow.operators.enrich import enrich
from tripflow.operators.normalize import malformed_rows, normalize_feed
from tripflow.schemas import FEED, PAYMENT_LABELS, ddl

RAW = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "trip_distance": "double",
    "PULocationID": "double",
    "DOLocationID": "string",
    "fare_amount": "string",
    "tip_amount": "double",
    "passenger_count": "string",
    "payment_type": "double",
}
NAN = float("nan")


def missing(value):
    return value is None or (isinstance(value, float) and math.isnan(value))


def time_text(time):
    if time is None:
        return None
    return str(time).rstrip("0") if time.microsecond else str(time)


def fed(row):
    """The feed row of a raw row, or None where it is malformed."""
    pickup, dropoff, miles, start, end, fare, tip, passengers, code = row
    if None in (miles, start, end, fare) or math.isnan(start):
        return None
    try:
        return (
            time_text(pickup),
            time_text(dropoff),
            float(miles),
            int(start),
            int(end),
            float(fare),
            0.0 if missing(tip) else float(tip),
            1 if passengers is None else int(passengers),
            "Unknown" if missing(code) else PAYMENT_LABELS.get(int(code), "Unknown"),
        )
    except ValueError:
        return None


def cleaned(row):
    """The ride of a feed row, or the reason it is dropped."""
    pickup, dropoff, miles, start, end, fare, *rest = row
    if pickup is None or dropoff is None or missing(miles) or missing(fare):
        return "missing value"
    if fare <= 0:
        return "fare not positive"
    if miles <= 0:
        return "distance not positive"
    try:
        times = [datetime.fromisoformat(text) for text in (pickup, dropoff)]
    except ValueError:
        return "time not readable"
    first, last = (time.replace(microsecond=0) for time in times)
    minutes = (last - first).total_seconds() / 60
    if minutes <= 0:
        return "duration not positive"
    names = {number: name for number, _, name, _ in ZONE_ROWS}
    added = (minutes, first.hour, names.get(start), names.get(end))
    return (*times, miles, start, end, fare, *rest, *added)


def comparable(row):
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)


@pytest.fixture(scope="module", params=[1, 2, 3])
def chance(request):
    return random.Random(request.param)


def test_normalisation(spark, chance):
    def time():
        moment = datetime(2024, 1, 1) + timedelta(microseconds=chance.randrange(10**13))
        return chance.choice([None, moment, moment.replace(microsecond=0)])

    rows = [
        (
            time(),
            time(),
            chance.choice([None, NAN, 0.0, chance.uniform(-1, 9)]),
            chance.choice([None, NAN, 3.0, 4.9]),
            chance.choice([None, "5", "x", "6.5", ""]),
            chance.choice([None, "12.5", "-3", "1e2", "free", "NaN"]),
            chance.choice([None, NAN, 1.25]),
            chance.choice([None, "2", "two", "2.5"]),
            chance.choice([None, NAN, 0.0, 1.0, 1.9, 2.0, 3.0, 4.0, 5.0, 6.0, 9.0, -1.0]),
        )
        for _ in range(3_000)
    ]
    trips = spark.createDataFrame(rows, ddl(RAW))
    expected = [fed(row) for row in rows]
    assert Counter(comparable(row) for row in normalize_feed(trips).collect()) == Counter(
        comparable(row) for row in expected if row
    )
    assert malformed_rows(trips).count() == expected.count(None)
    assert 100 < expected.count(None) < 2_990


def test_cleaning_and_reports(spark, chance):
    def time():
        moment = datetime(2024, 1, 1) + timedelta(seconds=chance.randrange(7200))
        text = chance.choice([moment, moment + timedelta(microseconds=chance.randrange(10**6))])
        return chance.choice([str(text)] * 8 + [None, "NaT"])

    def amount():
        return chance.choice([None, NAN, 0.0, -1.0] + [chance.uniform(0.01, 50)] * 8)

    rows = [
        (time(), time(), amount(), chance.randrange(8), chance.choice([None, 2, 6]), amount())
        + (chance.choice([None, 1.5]), chance.randrange(1, 7), chance.choice([None, "Card"]))
        for _ in range(3_000)
    ]
    feed = spark.createDataFrame(rows, ddl(FEED))
    results = [cleaned(row) for row in rows]
    kept = [row for row in results if isinstance(row, tuple)]
    rides = enrich(clean(feed), zones(spark))
    in_order = [*FEED, "ride_duration_minutes", "pickup_hour", "pickup_zone", "dropoff_zone"]
    assert Counter(tuple(row) for row in rides.select(*in_order).collect()) == Counter(kept)
    assert dict(tuple(row) for row in reject_reasons(feed).collect()) == Counter(
        row for row in results if isinstance(row, str)
    )

    assert dict(tuple(row) for row in metrics.trips_per_hour(rides).collect()) == Counter(
        row[10] for row in kept
    )
    by_zone = Counter(row[11] for row in kept if row[11])
    assert dict(tuple(row) for row in metrics.trips_per_zone(rides).collect()) == by_zone
    boroughs = {name: borough for _, borough, name, _ in ZONE_ROWS}
    by_borough = Counter(boroughs[row[11]] if row[11] else "Unknown" for row in kept)
    reported = metrics.trips_by_borough(rides, zones(spark)).collect()
    assert dict(tuple(row) for row in reported) == by_borough
    summary = metrics.kpi_summary(rides).first()
    assert summary.total_trips == len(kept)
    assert summary.total_revenue == pytest.approx(math.fsum(row[5] for row in kept))
    assert summary.average_duration == pytest.approx(math.fsum(row[9] for row in kept) / len(kept))
