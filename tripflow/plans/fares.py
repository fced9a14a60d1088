"""The fare model: features, training, evaluation and scoring.

The most frequent zones have an index of their own and the rest share a fixed number, so the
forest's bins and the driver's lists do not grow with the zones. The forest trains on a sample
whose size is set, whatever the trips' volume. Scoring is one pass over any number of requests.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from math import ceil
from operator import and_

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.functions.trips import fare_per_mile
from tripflow.operators.clean import clean
from tripflow.operators.enrich import enrich
from tripflow.operators.normalize import rename_trips
from tripflow.operators.requests import request_features
from tripflow.operators.sampling import split_parts, training_sample, with_split
from tripflow.schemas import (
    FOREST_BINS,
    FOREST_DEPTH,
    FOREST_TREES,
    LABEL,
    NUMERIC_FEATURES,
    PREDICTION,
    REQUESTS,
    SEED,
    SHARED_ZONE_BINS,
    TRAINING_SAMPLE_ROWS,
    ZONE_FEATURES,
    ddl,
)

INDEXES = [f"{name}_idx" for name in ZONE_FEATURES]
BINNED = [f"{name}_bin" for name in ZONE_FEATURES]
OWN, SHARED = "zone ", "shared "
FEATURES = [*NUMERIC_FEATURES, *INDEXES]
ROWS_PER_PART = 10_000


@dataclass
class FareTraining:
    model: PipelineModel
    train: DataFrame
    test: DataFrame

    @cached_property
    def rmse(self) -> float:
        """The error over the whole test part (runs a job, once, when it is asked for)."""
        return fare_rmse(self.model.transform(self.test))


def feature_assembler() -> VectorAssembler:
    """Puts the six features into a vector; rows lacking one are dropped."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")


def own_zones(rides: DataFrame) -> list[list[str]]:
    """Per zone column, the zones to tell apart: most rides first, equals by name (runs a job).

    Both columns are counted in one aggregation with partial counts. Each column's first zones
    are picked in the tasks before and after the shuffle, so the driver and every task get at
    most ``FOREST_BINS`` of them, however many zones there are.
    """
    side = F.posexplode(F.array(*ZONE_FEATURES)).alias("side", "zone")
    counts = rides.select(side).filter("zone is not null").groupBy("side", "zone").count()
    by_rides = Window.partitionBy("side").orderBy(F.desc("count"), "zone")
    first = counts.withColumn("rank", F.row_number().over(by_rides))
    ranked = sorted(first.filter(F.col("rank") <= FOREST_BINS).collect(), key=lambda r: r["rank"])
    return [[row.zone for row in ranked if row.side == side] for side in range(len(ZONE_FEATURES))]


def _shared_zones(name: str, zones: list[str]) -> SQLTransformer:
    """Replaces zones other than those given by one of ``SHARED_ZONE_BINS`` names.

    Names are compared as hex digits, so that any name can stand in the statement.
    """
    known = ", ".join(f"'{zone.encode().hex().upper()}'" for zone in zones)
    return SQLTransformer(
        statement=f"""
        select *, case
          when hex({name}) in ({known}) then concat('{OWN}', {name})
          when {name} is not null
            then concat('{SHARED}', cast(pmod(xxhash64({name}), {SHARED_ZONE_BINS}) as string))
        end as {name}_bin from __THIS__"""
    )


def zone_stages(zones: list[list[str]]) -> list[Transformer]:
    """Indexes both zone columns, given their ``own_zones``, within ``FOREST_BINS`` bins.

    Up to ``FOREST_BINS - 1`` zones all have their own index, by rank, and unseen and null zones
    share the next one. Of more, the first ones do; all others, unseen ones too, are dealt by
    their hash to ``SHARED_ZONE_BINS`` further indexes, and null has the one after these.
    """
    stages = []
    for name, index, ranked in zip(ZONE_FEATURES, INDEXES, zones, strict=True):
        labels = ranked
        if len(ranked) >= FOREST_BINS:
            ranked = ranked[: FOREST_BINS - 1 - SHARED_ZONE_BINS]
            stages.append(_shared_zones(name, ranked))
            labels = [f"{OWN}{zone}" for zone in ranked]
            labels += [f"{SHARED}{number}" for number in range(SHARED_ZONE_BINS)]
            name = f"{name}_bin"
        # One model a column: a model of several pads the shorter list of labels.
        stages.append(StringIndexerModel.from_labels(labels, name, index, handleInvalid="keep"))
    return stages


def fare_pipeline(
    zones: list[list[str]],
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = SEED,
) -> Pipeline:
    """Indexers for the ``own_zones``, assembler and forest."""
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=LABEL,
        predictionCol=PREDICTION,
        numTrees=trees,
        maxDepth=depth,
        maxBins=FOREST_BINS,
        seed=seed,
    )
    return Pipeline(stages=[*zone_stages(zones), feature_assembler(), forest])


def index_zones(rides: DataFrame) -> DataFrame:
    """Adds the zone indexes, ranked by the rides' own counts (runs a job)."""
    indexed = PipelineModel(zone_stages(own_zones(rides))).transform(rides)
    return indexed.drop(*BINNED)


def training_features(rides: DataFrame, key: list[str]) -> DataFrame:
    """The feature vector of each complete ride, spread over columns (runs a job)."""
    vectors = feature_assembler().transform(index_zones(rides))
    values = vector_to_array("features")
    return vectors.select(*key, *[values[i].alias(name) for i, name in enumerate(FEATURES)])


def training_rides(trips: DataFrame) -> DataFrame:
    """Clean rides of raw trips. Payment codes and missing passenger counts stay as they are."""
    return clean(rename_trips(trips))


def train_fare_model(
    trips: DataFrame,
    zones: DataFrame,
    work_folder: str,
    key: list[str] | None = None,
    sample_rows: int = TRAINING_SAMPLE_ROWS,
    **forest,
) -> FareTraining:
    """Samples, splits and fits (runs jobs); the error is worked out when it is asked for.

    All rides are split; ``sample_rows`` bounds the training rides that the fit sees, and the
    whole test part is evaluated. The sample is joined to the zones, spread over parts of about
    ``ROWS_PER_PART`` rows, written to ``work_folder`` and read back: the fit goes over it many
    times, and a lost executor then costs a re-read of a small file instead of another scan of
    the trips. ``key`` names the columns that identify a trip; with one, the same trips make the
    same sample, split and forest every time.
    """
    rides = training_rides(trips)
    needed = [LABEL, *NUMERIC_FEATURES, "pickup_location_id", "dropoff_location_id"]
    columns = dict.fromkeys([*(key or []), *needed])
    training, tested = split_parts(with_split(rides.select(*columns), key))
    chosen = enrich(training_sample(training, key, sample_rows), zones)
    parts = ceil(sample_rows / ROWS_PER_PART)
    if key:
        # The forest draws rows by their place, so places must not depend on the shuffle.
        dealt = chosen.repartition(parts, *key).sortWithinPartitions(*key)
    else:
        dealt = chosen.repartition(parts)
    dealt.write.parquet(work_folder)

    train = trips.sparkSession.read.parquet(work_folder)
    test = enrich(tested, zones)
    model = fare_pipeline(own_zones(train), **forest).fit(train)
    return FareTraining(model, train, test)


def fare_rmse(scored: DataFrame) -> float:
    """RMSE of scored rides (runs a job)."""
    evaluator = RegressionEvaluator(
        labelCol=LABEL, predictionCol=PREDICTION, metricName="rmse"
    )
    return evaluator.evaluate(scored)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _scoring_stages(model: PipelineModel) -> PipelineModel:
    """The model with an assembler that lets incomplete rows through."""
    stages = [
        stage.copy({stage.handleInvalid: "keep"}) if isinstance(stage, VectorAssembler) else stage
        for stage in model.stages
    ]
    return PipelineModel(stages)


def score_fares(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Requests with ``predicted_fare`` and ``fare_per_mile``.

    Every request is returned: one that lacks a number has null results rather than none. An
    unseen or missing zone scores through the extra bucket.
    """
    numbers = [F.col(name).cast("double") for name in NUMERIC_FEATURES]
    complete = reduce(and_, [value.isNotNull() & ~F.isnan(value) for value in numbers])
    scored = _scoring_stages(model).transform(request_features(requests))
    fare = F.when(complete, F.col(PREDICTION))
    return (
        scored.withColumn(PREDICTION, fare)
        .withColumn("fare_per_mile", fare_per_mile(F.col(PREDICTION), F.col("trip_distance")))
        .drop("features", "rawPrediction", *INDEXES, *BINNED)
    )


def predict_fare(
    spark: SparkSession,
    model: PipelineModel,
    distance: float,
    passengers: int,
    pickup_hour: int,
    pickup_zone: str | None,
    dropoff_zone: str | None,
) -> float:
    """The fare of one request (runs a job); for many, use ``score_fares``."""
    request = (float(distance), int(passengers), int(pickup_hour), pickup_zone, dropoff_zone)
    return score_fares(spark.createDataFrame([request], ddl(REQUESTS)), model).first()[PREDICTION]
