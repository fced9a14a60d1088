"""Sums in parts against Python's exact fractions and ``fsum``."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripflow.functions.exact import PLACES, exact_sum, merged_sum, sum_value
from tripflow.operators import metrics
from tripflow.operators.rollup import ride_rollup
from tripflow.plans import events

FOLDER = "/root/testdata/sf0.001"


def table(spark, values):
    rows = [(place % 7, value) for place, value in enumerate(values)]
    return spark.createDataFrame(rows, "g int, x double")


def summed(frame):
    return frame.agg(sum_value(exact_sum("x")).alias("total")).first().total


@pytest.fixture(scope="module")
def amounts():
    draw = random.Random(5)
    return [draw.choice([1, -1]) * draw.random() * 10 ** draw.randint(-6, 12) for _ in range(3_000)]


def test_parts_hold_the_sum_exactly(spark, amounts):
    parts = table(spark, amounts).agg(exact_sum("x").alias("s")).first().s
    held = sum(Fraction(parts[name]) * Fraction(2) ** place for name, place in PLACES.items())
    unit = Fraction(2) ** min(PLACES.values())
    assert held == sum(int(Fraction(x) / unit) * unit for x in amounts)
    assert parts.beyond is None


def test_the_total_is_the_exact_sum_rounded(spark, amounts):
    positive = [abs(x) for x in amounts]
    assert summed(table(spark, positive)) == math.fsum(positive)
    negative = summed(table(spark, [-x for x in positive]))
    assert negative == pytest.approx(-math.fsum(positive), rel=1e-15)
    assert summed(table(spark, [0.1] * 10)) == math.fsum([0.1] * 10)
    assert summed(table(spark, [1e15, 0.1, -1e15])) == 0.1


def test_order_and_grouping_do_not_matter(spark, amounts):
    shuffled = random.Random(6).sample(amounts, len(amounts))
    frames = [table(spark, amounts).coalesce(1), table(spark, shuffled).repartition(64)]
    assert len({summed(frame) for frame in frames}) == 1
    per_group = frames[1].groupBy("g").agg(exact_sum("x").alias("s"))
    assert per_group.agg(sum_value(merged_sum("s"))).first()[0] == summed(frames[0])


@pytest.mark.parametrize(
    "values, total",
    [
        ([], None),
        ([None, None], None),
        ([None, 2.5], 2.5),
        ([-0.0], 0.0),
        ([1.5, 2.0**60, None], 2.0**60 + 1.5),
        ([2.0**60], 2.0**60),
        ([1.0, math.inf], math.inf),
        ([1e-30], 0.0),
    ],
)
def test_values_without_places(spark, values, total):
    assert summed(table(spark, values)) == total


def test_nan_and_opposite_infinities_give_nan(spark):
    assert math.isnan(summed(table(spark, [1.0, math.nan])))
    assert math.isnan(summed(table(spark, [math.inf, -math.inf])))


def test_reports_do_not_depend_on_partitions(spark):
    rides = events.rides(spark, FOLDER)
    forms = [rides.coalesce(1), rides.repartition(64), rides.orderBy(F.desc("fare_amount"))]
    forms += [ride_rollup(forms[1]), ride_rollup(forms[0]).repartition(13)]
    for report in (metrics.kpi_summary, metrics.average_tip, metrics.average_fare_by_hour):
        assert len({tuple(report(form).collect()) for form in forms}) == 1
