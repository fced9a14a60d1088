import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tests.builders import zones
from tripflow.operators import display
from tripflow.operators.metrics import mean_predictor_rmse
from tripflow.operators.sampling import with_split
from tripflow.plans import fares
from tripflow.schemas import REQUESTS, ddl

TRIP = (
    "trip_id bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "trip_distance double, PULocationID bigint, DOLocationID bigint, fare_amount double, "
    "tip_amount double, passenger_count bigint, payment_type bigint"
)


@pytest.fixture(scope="module")
def trips(spark):
    """Trips whose fare follows distance, duration and pickup zone."""
    chance = random.Random(7)
    rows = []
    for n in range(3_000):
        start = datetime(2024, 1, 1) + timedelta(minutes=7 * n)
        miles = chance.uniform(0.5, 20)
        minutes = miles * chance.uniform(2, 5)
        pickup = chance.choice([1, 2, 3, 5, 77, None])
        fare = 3 + 2.5 * miles + 0.3 * minutes + (20 if pickup == 2 else 0)
        passengers = None if n % 50 == 0 else 1 + n % 4
        end = start + timedelta(minutes=minutes)
        rows.append((n, start, end, miles, pickup, 1 + n % 4, fare, None, passengers, 1))
    return spark.createDataFrame(rows, TRIP)


@pytest.fixture(scope="module")
def training(spark, trips, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("work") / "sample")
    return fares.train_fare_model(trips, zones(spark), folder, key=["trip_id"], trees=10, depth=6)


def test_model_beats_the_mean(training, trips):
    rides = with_split(fares.training_rides(trips), ["trip_id"])
    assert training.rmse < 0.5 * mean_predictor_rmse(rides).first().rmse
    assert training.train.count() + training.test.count() == 3_000


def test_training_drops_rows_without_passengers(training):
    complete = training.test.filter("passenger_count is not null").count()
    assert training.model.transform(training.test).count() == complete < training.test.count()


def test_rmse_equals_its_definition(training):
    scored = training.model.transform(training.test)
    error = scored.select(F.sqrt(F.avg((F.col("fare_amount") - F.col("predicted_fare")) ** 2)))
    assert training.rmse == pytest.approx(error.first()[0])


def test_saved_model_scores_the_same(training, tmp_path):
    path = str(tmp_path / "model")
    fares.save_model(training.model, path)
    fares.save_model(training.model, path)
    before, after = (
        [row.predicted_fare for row in model.transform(training.test).orderBy("trip_id").collect()]
        for model in (training.model, fares.load_model(path))
    )
    assert before == after


def test_the_same_trips_train_the_same_split(spark, trips, training, tmp_path):
    again = fares.train_fare_model(
        trips.repartition(7), zones(spark), str(tmp_path / "s"), key=["trip_id"], trees=1, depth=1
    )
    ids = [sorted(row.trip_id for row in part.collect()) for part in (again.train, training.train)]
    assert ids[0] == ids[1]


def test_without_a_key_each_row_is_drawn_on_its_own(spark, trips, tmp_path):
    copies = trips.filter("trip_id = 1").drop("trip_id").crossJoin(spark.range(3_000)).drop("id")
    training = fares.train_fare_model(
        copies, zones(spark), str(tmp_path / "s"), sample_rows=1_000, trees=1, depth=1
    )
    # The fit is bounded, the test part is a fifth of all rides.
    assert 850 < training.train.count() < 1_150
    assert 500 < training.test.count() < 700


def test_sample_is_about_the_size_asked_for(spark, trips, tmp_path):
    tiny = {"sample_rows": 1_000, "trees": 1, "depth": 1}
    training = fares.train_fare_model(
        trips, zones(spark), str(tmp_path / "s"), key=["trip_id"], **tiny
    )
    assert 900 < training.train.count() < 1_100
    everything = fares.training_rides(trips).count()
    assert 0.15 * everything < training.test.count() < 0.25 * everything


def test_forest_settings(spark):
    *_, forest = fares.fare_pipeline([["a"], ["b"]]).getStages()
    assert forest.getMaxBins() == 300
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (50, 8, 42)


def zone_rides(spark, names):
    return spark.createDataFrame(
        [(n, name, name) for n, name in enumerate(names)],
        "n int, pickup_zone string, dropoff_zone string",
    )


def test_few_zones_are_indexed_as_spark_does(spark):
    names = [f"zone '{n % 299}" for n in range(1_000)] + [None]
    rides = zone_rides(spark, names)
    indexer = StringIndexer(
        inputCols=["pickup_zone", "dropoff_zone"], outputCols=fares.INDEXES, handleInvalid="keep"
    )
    expected = indexer.fit(rides).transform(rides)
    assert sorted(fares.index_zones(rides).collect()) == sorted(expected.collect())


def test_of_many_zones_the_frequent_ones_keep_an_index(spark):
    odd = ["it's", "back\\slash", "zone 1", "shared 3", "", "Zürich", "sé\n\"x"]
    names = [name for name in odd for _ in range(5)] + [f"z{n}" for n in range(4_000)] + [None]
    rows = fares.index_zones(zone_rides(spark, names)).collect()
    index = {row.pickup_zone: row.pickup_zone_idx for row in rows}
    assert all(row.pickup_zone_idx == row.dropoff_zone_idx for row in rows)
    assert len(rows) == len(names) and set(rows[0].asDict()) == {
        "n", "pickup_zone", "dropoff_zone", *fares.INDEXES
    }
    own = 300 - 1 - 32
    assert [index[name] for name in sorted(odd)] == list(range(len(odd)))
    assert index[None] == 299
    ranked = sorted(f"z{n}" for n in range(4_000))[: own - len(odd)]
    assert [index[name] for name in ranked] == list(range(len(odd), own))
    shared = [index[name] for name in set(names) - set(odd) - set(ranked) - {None}]
    assert set(shared) == set(range(own, 299))
    assert max(shared.count(bin) for bin in set(shared)) < 2 * len(shared) / 32


def test_a_hundred_thousand_zones_train_within_the_same_bins(spark, tmp_path):
    """One zone is dear; the others are met too seldom to have a bin."""
    dimension = spark.range(1, 100_001).selectExpr(
        "cast(id as int) LocationID", "'B' Borough", "concat('Zone ', id) Zone", "'x' service_zone"
    )
    trips = spark.range(20_000).selectExpr(
        "id trip_id",
        "timestamp_ntz '2024-01-01 10:00:00' tpep_pickup_datetime",
        "timestamp_ntz '2024-01-01 10:30:00' tpep_dropoff_datetime",
        "1.0d + id % 7 trip_distance",
        "if(id % 3 = 0, 5, 1 + pmod(xxhash64(id), 100000)) PULocationID",
        "1 + pmod(xxhash64(id, 1), 100000) DOLocationID",
        "if(id % 3 = 0, 60.0d, 10.0d) fare_amount",
        "0.0d tip_amount",
        "1L passenger_count",
        "1L payment_type",
    )
    training = fares.train_fare_model(
        trips, dimension, str(tmp_path / "s"), key=["trip_id"], trees=8, depth=4
    )
    assert training.model.stages[-1].getMaxBins() == 300
    rides = with_split(fares.training_rides(trips), ["trip_id"])
    assert training.rmse < 0.3 * mean_predictor_rmse(rides).first().rmse
    path = str(tmp_path / "model")
    fares.save_model(training.model, path)
    pairs = [(zone, other) for zone in ("Zone 5", "Unheard of") for other in ("Zone 9", None)]
    asked = [(1.0, 1, 10, *pair) for pair in pairs]
    requests = spark.createDataFrame(asked, ddl(REQUESTS))
    scored = fares.score_fares(requests, fares.load_model(path))
    added = ["ride_duration_minutes", "predicted_fare", "fare_per_mile"]
    assert scored.columns == [*requests.columns, *added]
    assert {row.pickup_zone: row.predicted_fare > 35 for row in scored.collect()} == {
        "Zone 5": True, "Unheard of": False
    }


def test_every_request_is_answered(spark, training):
    rows = [
        (1, 3.0, 1, 12, "Alpha", "Beta"),
        (2, 3.0, 1, 12, "Never seen", None),
        (3, 0.0, 1, 12, "Alpha", "Beta"),
        (4, None, 1, 12, "Alpha", "Beta"),
        (5, 3.0, None, 12, "Alpha", "Beta"),
        (6, float("nan"), 1, 12, "Alpha", "Beta"),
    ]
    requests = spark.createDataFrame(rows, f"request_id bigint, {ddl(REQUESTS)}")
    scored = {row.request_id: row for row in fares.score_fares(requests, training.model).collect()}
    assert set(scored) == {1, 2, 3, 4, 5, 6}
    assert scored[1].fare_per_mile == pytest.approx(scored[1].predicted_fare / 3)
    assert scored[2].predicted_fare > 0
    assert scored[3].fare_per_mile == 0.0
    assert all(scored[n].predicted_fare is None for n in (4, 5, 6))
    assert scored[5].passenger_count is None

    whole = training.model.transform(
        requests.filter("request_id in (1, 2, 3)").withColumn(
            "ride_duration_minutes", F.col("trip_distance") * 4
        )
    )
    assert {row.request_id: row.predicted_fare for row in whole.collect()} == {
        n: scored[n].predicted_fare for n in (1, 2, 3)
    }


def test_one_request_is_predicted_as_among_many(spark, training):
    asked = (3.0, 2, 9, "Alpha", None)
    many = fares.score_fares(spark.createDataFrame([asked] * 3, ddl(REQUESTS)), training.model)
    fare = fares.predict_fare(spark, training.model, *asked)
    assert {row.predicted_fare for row in many.collect()} == {fare}


def test_result_card(spark, training):
    requests = spark.createDataFrame([(3.0, 1, 7, "Alpha", "Beta")], ddl(REQUESTS))
    row = display.fare_card(fares.score_fares(requests, training.model)).first()
    assert row.fare_text == f"${row.predicted_fare:,.2f}"
    assert row.per_mile_text == f"${row.fare_per_mile:,.2f}"
    assert (row.distance_text, row.hour_text) == ("3.0 mi", "07:00")
