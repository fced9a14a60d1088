"""Sampling and splitting by row key, so that the same rows are picked on every cluster.

Without a key rows are drawn by a seeded ``rand``: each on its own, so that a group of copies,
however large, is neither all in nor all out. A task that is run again draws the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.keys import row_key, sample_position, split_bucket
from tripflow.schemas import SEED, TRAIN_PERCENT, TRAINING_SAMPLE_ROWS


def training_sample(
    rides: DataFrame, key: list[str] | None = None, rows: int = TRAINING_SAMPLE_ROWS
) -> DataFrame:
    """About ``rows`` rides, each kept with the same chance; all of them when there are fewer.

    The total is a scalar subquery, so counting and sampling are one job and the count reads
    only the columns that the rides' own filters need.
    """
    total = rides.agg(F.count(F.lit(1))).scalar()
    position = sample_position(row_key(key)) if key else F.rand(SEED)
    return rides.filter(position < F.lit(float(rows)) / total)


def _in_train(key: list[str] | None, train_percent: int) -> Column:
    bucket = split_bucket(row_key(key)) if key else F.rand(SEED + 1) * 100
    return bucket < train_percent


def with_split(
    rides: DataFrame, key: list[str] | None = None, train_percent: int = TRAIN_PERCENT
) -> DataFrame:
    """Adds ``split``: ``train`` or ``test``."""
    part = F.when(_in_train(key, train_percent), "train").otherwise("test")
    return rides.withColumn("split", part)


def split_parts(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The train and the test rides of ``with_split``."""
    return tuple(marked.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
