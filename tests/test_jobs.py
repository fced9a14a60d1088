"""The command line, end to end: trips to feed to rides to report, and trips to model to fares."""

from datetime import datetime, timedelta

import pytest

from tests.builders import ZONE_ROWS
from tripflow import jobs
from tripflow.schemas import REQUESTS, ddl
from tripflow.sources.files import read_rides


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    lines = [",".join(f'"{v}"' if v is not None else "" for v in row) for row in ZONE_ROWS]
    (root / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n" + "\n".join(lines))
    start = datetime(2024, 1, 1)
    rows = [
        (
            start + timedelta(minutes=11 * n),
            start + timedelta(minutes=11 * n + n % 30),
            1.0 + n % 9,
            1 + n % 5,
            1 + n % 3,
            5.0 + 2.0 * (n % 9),
            None,
            1 + n % 3,
            n % 8,
        )
        for n in range(600)
    ]
    schema = (
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "trip_distance double, PULocationID bigint, DOLocationID bigint, fare_amount double, "
        "tip_amount double, passenger_count bigint, payment_type bigint"
    )
    spark.createDataFrame(rows, schema).write.parquet(str(root / "trips"))
    return lambda name: str(root / name)


def test_feed_stream_report_compact(spark, place, capsys):
    for fmt in ("parquet", "csv"):
        jobs.main(
            ["feed", "--trips", place("trips"), "--feed", place("feed"), "--format", fmt]
            + ["--rows-per-file", "100"]
        )
    stream = ["stream", "--feed", place("feed"), "--zones", place("zones.csv")]
    stream += ["--rides", place("rides"), "--checkpoint", place("checkpoint")]
    jobs.main([*stream, "--available-now", "--files-per-trigger", "5"])
    rides = read_rides(spark, place("rides"))
    assert rides.count() == 2 * 600 * 29 // 30

    report = ["report", "--rides", place("rides"), "--zones", place("zones.csv")]
    jobs.main(report)
    shown = capsys.readouterr().out
    spark.range(1).selectExpr("560L as trips").write.parquet(place("totals"))
    for live in ("+600", "+0"):
        jobs.main([*report, "--totals", place("totals")])
        page = capsys.readouterr().out.split("peak_hour")[0]
        assert live in page
    assert "1,160 rides processed" in shown and "boroughs" in shown

    again = [*stream[:5], "--rides", place("rides2"), "--checkpoint", place("checkpoint2")]
    jobs.main([*again, "--rollup", place("sums"), "--available-now", "--files-per-trigger", "5"])
    capsys.readouterr()
    jobs.main(
        ["report", "--rides", place("rides2"), "--zones", place("zones.csv")]
        + ["--rollup", place("sums")]
    )
    sections = [text.split("recent")[0] for text in (shown, capsys.readouterr().out)]
    assert sections[0] == sections[1]

    jobs.main(["compact", "--rides", place("rides"), "--target", place("compact")])
    assert read_rides(spark, place("compact")).count() == rides.count()


def test_train_and_score(spark, place, capsys):
    train = ["train", "--trips", place("trips"), "--zones", place("zones.csv")]
    jobs.main([*train, "--model", place("model"), "--trees", "5", "--depth", "4"])
    assert "Test RMSE" in capsys.readouterr().out

    asked = [(3.0, 1, 12, "Alpha", "Beta"), (0.0, 1, 12, "Alpha", "Beta")]
    spark.createDataFrame(asked, ddl(REQUESTS)).write.parquet(place("requests"))
    jobs.main(
        ["score", "--requests", place("requests"), "--model", place("model")]
        + ["--scores", place("scores")]
    )
    (bad,) = spark.read.parquet(place("scores") + "-rejected").collect()
    assert bad.trip_distance == 0.0 and bad.reason == "trip_distance"
    (row,) = spark.read.parquet(place("scores")).collect()
    assert row.predicted_fare > 0 and row.fare_text.startswith("$")


def test_a_job_must_be_named():
    with pytest.raises(SystemExit):
        jobs.main([])
