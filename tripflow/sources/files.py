"""Historical trips, the zone dimension, feed files and the ride table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schemas import RIDES, ROLLUP, ZONES, ddl


def read_trips(
    spark: SparkSession, path: str, glob: str = "*.parquet", schema: str | None = None
) -> DataFrame:
    """Historical trips: the Parquet files of a folder, whatever else lies beside them.

    Without ``schema`` the files' own is used, extra columns included.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if schema:
        reader = reader.schema(schema)
    try:
        trips = reader.parquet(path)
    except AnalysisException as error:
        # A folder without any matching file has no schema to infer.
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise FileNotFoundError(f"no {glob} files in {path}") from error
        raise
    return trips


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone dimension: a CSV file with a header. ``NA`` is a zone name, not a null."""
    return (
        spark.read.schema(ddl(ZONES))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def write_feed(
    feed: DataFrame, path: str, rows_per_file: int, fmt: str = "parquet", by: tuple[str, ...] = ()
) -> None:
    """Feed files of at most ``rows_per_file`` rows, published when the whole write commits.

    With ``by``, each value of those columns has a folder of its own and they leave the files.
    """
    writer = feed.write.option("maxRecordsPerFile", rows_per_file).mode("append")
    if by:
        writer = writer.partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table; no rows while it does not exist. Any other failure is raised."""
    empty = spark.createDataFrame([], schema)
    try:
        # Partition folders add a column of their own.
        return spark.read.schema(schema).parquet(path).select(*empty.columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty


def read_rides(spark: SparkSession, path: str) -> DataFrame:
    """The ride table; no rows while it does not exist."""
    return _read_or_empty(spark, path, ddl(RIDES))


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The rollup that a ride job keeps; no rows while it does not exist."""
    return _read_or_empty(spark, path, ddl(ROLLUP))


def read_totals(spark: SparkSession, path: str) -> DataFrame | None:
    """The highest total that ``add_total`` stored, as a rollup of one row; None before the first."""
    totals = _read_or_empty(spark, path, "trips bigint")
    if totals.isEmpty():
        return None
    return totals.agg(F.max("trips").alias("trips"))


def add_total(rollup: DataFrame, path: str) -> None:
    """Stores how many rides a rollup stands for, as one more row."""
    total = rollup.agg(F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("trips"))
    total.write.mode("append").parquet(path)


#: The query of batches that were written before a table named the queries.
EARLIER = "earlier"


def compact_rides(spark: SparkSession, source: str, target: str) -> None:
    """Rewrites a table of many small files into a new folder of well-sized ones.

    The rebalance hint lets adaptive execution size the output files, splitting large
    partitions as well as joining small ones. A table of micro-batches keeps its partitions, so
    that the stream can go on with the new folder; batches without a query get one.
    """
    rides = spark.read.schema(ddl(RIDES)).parquet(source)
    if "batch_id" in rides.columns and "query_id" not in rides.columns:
        rides = rides.withColumn("query_id", F.lit(EARLIER))
    by = [name for name in ("query_id", "batch_id") if name in rides.columns]
    writer = rides.hint("rebalance", *by).write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(target)
