"""Report pages, and reports from a rollup against those from the rides."""

import pytest

from tests.builders import rides, zones
from tripflow.operators import metrics
from tripflow.operators.rollup import ride_rollup
from tripflow.plans import events, reports

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("named", [False, True])
def test_rollup_gives_the_same_reports(spark, tmp_path, named):
    dimension = events.zones(spark, BASE)
    table = (events.named_rides if named else events.rides)(spark, BASE)
    rollup = reports.stored_rollup(table, str(tmp_path / "rollup"))
    assert ("pickup_zone" in rollup.columns) == named
    for report in (
        metrics.kpi_summary,
        metrics.average_tip,
        metrics.live_incoming,
        metrics.trips_per_hour,
        metrics.peak_hour,
        metrics.average_fare_by_hour,
        metrics.payment_mix,
    ):
        assert report(rollup).collect() == report(table).collect()
    for report in (
        metrics.busiest_zone,
        metrics.top_pickup_zones,
        metrics.trips_by_borough,
    ):
        assert report(rollup, dimension).collect() == report(table, dimension).collect()
    counts = [
        sorted(metrics.trips_per_zone(form, dimension).collect()) for form in (rollup, table)
    ]
    assert counts[0] == counts[1]
    earlier = table.filter("pickup_hour < 12")
    incoming = metrics.live_incoming(rollup, ride_rollup(earlier)).first()
    assert incoming == metrics.live_incoming(table, earlier).first()


def test_rollup_counts_missing_measures_and_groups_as_the_rides_do(spark):
    table = rides(
        spark,
        {"tip_amount": None, "payment_type": None},
        {"tip_amount": 4.0, "pickup_zone": None},
        {"tip_amount": 1.0, "pickup_hour": None},
    )
    rollup = ride_rollup(table)
    for report in (metrics.average_tip, metrics.payment_mix, metrics.trips_per_hour):
        assert report(rollup).collect() == report(table).collect()


def test_empty_rollup(spark):
    empty = ride_rollup(rides(spark, {}).filter("false"))
    assert tuple(metrics.kpi_summary(empty).first()) == (0, 0.0, None, None, None)
    assert metrics.live_incoming(empty, empty).first().live_incoming == 0
    assert metrics.busiest_zone(empty).count() == 0


def test_pages(spark):
    table = rides(spark, {}, {"pickup_hour": 11})
    pages = {
        **reports.overview(table),
        **reports.analytics(table, zones(spark)),
        **reports.latest(table),
    }
    assert {name: frame.count() for name, frame in pages.items()} == {
        "kpis": 1,
        "live": 1,
        "peak_hour": 1,
        "busiest_zone": 1,
        "average_tip": 1,
        "hours": 2,
        "payments": 1,
        "top_zones": 1,
        "boroughs": 1,
        "recent": 2,
    }
