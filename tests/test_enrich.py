from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.builders import zones
from tripflow.operators import enrich as joins

# One id holds a third of the rows, another third has no id, the rest is spread thin; 5,000 and
# above match no zone.
ROWS = 9_000


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None))
    return spark.range(ROWS).select(
        "id", key.otherwise(F.col("id") % 7_000).cast("bigint").alias("pickup_location_id")
    )


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(5_000).selectExpr("cast(id as int) as LocationID", "concat('z', id) as Zone")


def as_counter(frame):
    return Counter(tuple(row) for row in frame.select("id", "pickup_zone").collect())


def expected(rows, copies=1):
    found = Counter()
    for row in rows.collect():
        key = row.pickup_location_id
        matches = key is not None and key < 5_000
        found[(row.id, f"z{key}" if matches else None)] += copies if matches else 1
    return found


@pytest.mark.parametrize("hot_keys", [1, 50, 1_000])
def test_shuffled_join_equals_the_definition(skewed, dimension, monkeypatch, hot_keys):
    monkeypatch.setattr(joins, "HOT_KEYS", hot_keys)
    joined = joins.enrich(skewed, dimension, ("pickup",), small=False)
    assert as_counter(joined) == expected(skewed)


def test_broadcast_join_equals_the_definition(skewed, dimension):
    assert as_counter(joins.enrich(skewed, dimension, ("pickup",), small=True)) == expected(skewed)


@pytest.mark.parametrize("small", [True, False])
def test_repeated_dimension_keys_fan_out_as_in_any_left_join(skewed, dimension, small):
    twice = dimension.union(dimension)
    joined = joins.enrich(skewed, twice, ("pickup",), small=small)
    assert as_counter(joined) == expected(skewed, copies=2)


def test_hot_and_missing_keys_are_salted_in_one_pass(spark, skewed, dimension):
    shuffled = joins.enrich(skewed, dimension, ("pickup",), small=False)
    plan = shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "Union" not in plan and "Cross" not in plan


def test_hot_ids_are_those_above_their_share(skewed, monkeypatch):
    for share, ids in ((2, set()), (4, {1})):
        monkeypatch.setattr(joins, "HOT_KEYS", share)
        assert {row[0] for row in joins.hot_ids(skewed, "pickup_location_id").collect()} == ids


def test_bounds_decide(dimension):
    names = dimension.select("LocationID", "Zone")
    assert joins.fits_broadcast(names)
    assert not joins.fits_broadcast(names, max_rows=4_999)
    assert joins.fits_broadcast(names, max_rows=5_000)
    assert not joins.fits_broadcast(names, max_bytes=1_000)
    assert joins.fits_broadcast(names.limit(0))


def test_large_dimension_goes_the_other_way_by_itself(skewed, dimension, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    both = joins.enrich(skewed.withColumn("dropoff_location_id", F.lit(2)), dimension)
    assert as_counter(both) == expected(skewed)
    assert {row.dropoff_zone for row in both.collect()} == {"z2"}


def test_unmatched_and_missing_ids_have_no_zone(spark):
    rides = spark.createDataFrame(
        [(1, 99), (None, 2), (5, 6)], "pickup_location_id bigint, dropoff_location_id bigint"
    )
    joined = joins.enrich(rides, zones(spark))
    assert Counter((row.pickup_zone, row.dropoff_zone) for row in joined.collect()) == Counter(
        [("Alpha", None), (None, "Beta"), ("NA", None)]
    )
