"""What the physical plans must look like for the operators to hold at volume."""

import pytest

import __spark_entry__ as registry
from tests.builders import feed, zones
from tests.comparing import TABLES
from tripflow.operators import enrich, metrics, sampling
from tripflow.operators.clean import clean
from tripflow.operators.rollup import ride_rollup
from tripflow.schemas import FEED, ddl

FOLDER = str(TABLES / "sf0.001")
STREAMED = [name for name in registry.queries() if name.startswith("stream_")]
MODEL = ["fare_model_rmse", "fare_model_predictions", "score_requests"]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "feed")
    feed(spark, {}, {"fare_amount": -1.0}).write.parquet(path)
    return spark.read.schema(ddl(FEED)).parquet(path)


def test_comparisons_reach_the_scan(stored_feed):
    plan = plan_of(clean(stored_feed))
    assert "GreaterThan(fare_amount,0.0)" in plan
    assert "GreaterThan(trip_distance,0.0)" in plan


def test_each_time_is_parsed_once(stored_feed):
    plan = plan_of(clean(stored_feed))
    assert plan.count("try_cast(pickup_datetime") == 1
    assert plan.count("try_cast(dropoff_datetime") == 1


def test_scans_read_only_what_a_report_needs(stored_feed):
    plan = plan_of(metrics.trips_per_hour(clean(stored_feed)))
    (schema,) = [part for part in plan.split("ReadSchema: ")[1:]]
    assert "payment_type" not in schema and "tip_amount" not in schema


def test_cleaning_does_not_shuffle(stored_feed, spark):
    plan = plan_of(enrich.enrich(clean(stored_feed), zones(spark)))
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan
    assert plan.count("BroadcastHashJoin") == 2


def test_counts_are_joined_to_zones_after_the_aggregation(stored_feed, spark):
    plan = plan_of(metrics.trips_by_borough(clean(stored_feed), zones(spark)))
    scan = plan.index("FileScan")
    below = [line for line in plan[:scan].splitlines() if "partial_count" in line or "Join" in line]
    assert "partial_count" in below[-1]


def test_latest_rides_are_taken_before_names_are_joined(stored_feed, spark):
    plan = plan_of(metrics.recent_rides(clean(stored_feed), zones(spark)))
    assert plan.count("TakeOrderedAndProject") == 2
    assert "rangepartitioning" not in plan


def test_payment_total_uses_the_grouped_counts(stored_feed):
    mix = metrics.payment_mix(clean(stored_feed))
    mix.collect()
    plan = plan_of(mix)
    assert "ReusedExchange" in plan and "Window" not in plan


def test_sampling_and_splitting_do_not_shuffle_rows(stored_feed):
    rides = clean(stored_feed)
    for frame in (
        sampling.with_split(rides, ["pickup_datetime"]),
        sampling.training_sample(rides, ["pickup_datetime"]),
    ):
        assert "hashpartitioning" not in plan_of(frame)


@pytest.mark.parametrize(
    "name", sorted(set(registry.queries()) - set(STREAMED) - set(MODEL))
)
def test_no_query_multiplies_rows_or_runs_python(name, spark):
    plan = plan_of(registry.queries()[name](spark, FOLDER))
    operators = ["CartesianProduct", "BroadcastNestedLoopJoin"]
    if not name.startswith("op") and name != "pipeline":
        # Training-data operators may run Python, and number rows within parts of a set size.
        operators += ["Python", "Window"]
    for operator in operators:
        assert operator not in plan


def test_a_rollup_is_one_partial_aggregation_of_one_scan(stored_feed):
    plan = plan_of(ride_rollup(clean(stored_feed)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
