from hashlib import md5

import pytest

from tripflow.operators.sampling import split_parts, training_sample, with_split


@pytest.fixture(scope="module")
def numbered(spark):
    return spark.range(2_000).withColumnRenamed("id", "trip_id")


def test_split_follows_the_md5_of_the_key(numbered):
    for row in with_split(numbered, ["trip_id"]).collect():
        bucket = int(md5(str(row.trip_id).encode()).hexdigest()[:6], 16) % 100
        assert row.split == ("train" if bucket < 80 else "test")


def test_split_parts_are_whole_and_disjoint(numbered):
    train, test = split_parts(with_split(numbered, ["trip_id"], train_percent=30))
    assert train.intersect(test).count() == 0
    assert train.unionByName(test).distinct().count() == 2_000
    assert 500 < train.count() < 700


def test_sample_does_not_depend_on_partitions(numbered):
    ids = [
        sorted(row.trip_id for row in training_sample(frame, ["trip_id"], 500).collect())
        for frame in (numbered.coalesce(1), numbered.repartition(13))
    ]
    assert ids[0] == ids[1]
    assert 420 < len(ids[0]) < 580


def test_small_tables_are_kept_whole(numbered):
    assert training_sample(numbered, ["trip_id"], 2_000).count() == 2_000
    assert training_sample(numbered, ["trip_id"], 10**9).count() == 2_000
    assert training_sample(numbered.filter("false"), ["trip_id"], 10).count() == 0


def test_equal_rows_share_their_side(spark):
    rows = spark.createDataFrame([(1, None, 2.5)] * 5 + [(None, 1, 2.5)], "a int, b int, c double")
    marked = with_split(rows, ["a", "b", "c"])
    assert marked.filter("a = 1").select("split").distinct().count() == 1


def test_without_a_key_copies_are_drawn_one_by_one(spark):
    copies = spark.range(4_000).selectExpr("1 as a")
    drawn = training_sample(copies, rows=1_000)
    assert 850 < drawn.count() == drawn.count() < 1_150
    train, test = split_parts(with_split(copies))
    assert train.count() + test.count() == 4_000
    assert 3_000 < train.count() < 3_400
