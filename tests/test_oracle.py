"""Every registered query against its DuckDB SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as registry
from tests.comparing import TABLES, duck, oracle_rows, spark_rows

FOLDER = str(TABLES / f"sf{os.environ.get('TRIPFLOW_SF', '0.001')}")
ORACLE = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    without = {name for name in set(QUERIES) - set(ORACLE) if not name.startswith("op")}
    assert without <= {"pipeline", "fare_errors", "fare_predictions", "scored_fares"}


def test_the_models_numbers_agree_with_its_flags(spark):
    """What SQL cannot state: predictions, their error, and cards of scored requests."""
    (errors,) = QUERIES["fare_errors"](spark, FOLDER).collect()
    rows = QUERIES["fare_predictions"](spark, FOLDER).collect()
    assert errors.test_rows == len(rows)
    squares = [(row.fare_amount - row.predicted_fare) ** 2 for row in rows]
    assert errors.forest_rmse == pytest.approx((sum(squares) / len(squares)) ** 0.5)
    assert len({round(row.predicted_fare, 6) for row in rows}) > 10
    cards = QUERIES["scored_fares"](spark, FOLDER).collect()
    assert all(row.predicted_fare > 0 and row.fare_text.startswith("$") for row in cards)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(name, spark, connection):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, expected = oracle_rows(connection, ORACLE[name])
    assert names == expected_names
    assert rows == expected
    assert sum(rows.values()) > 0


def test_entry(spark):
    hours = registry.entry(spark).collect()
    assert [row.pickup_hour for row in hours] == sorted(row.pickup_hour for row in hours)
