"""Streams over a feed folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.schemas import FEED, RECORD, ddl
from tripflow.sources.folders import ensure_folder

GLOBS = {"csv": "*.csv", "parquet": "*.parquet"}


def feed_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    *,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
    schema: str | None = None,
    record: bool = False,
) -> DataFrame:
    """Stream of a folder's files of one format; ``path`` may have wildcards.

    The declared schema lets an empty folder wait for files; the folder is made if it is not
    there. The glob keeps other formats and half-written ``.tmp`` files out. One file per
    trigger shows every arrival; for volume, leave it unset or limit bytes instead.

    A CSV file whose header does not match the schema stops the stream: reading it by position
    would silently mix up columns. With ``record``, the rows have that column as well: the text of
    a CSV record that does not fit the types, and null for all others. Without it such a record
    has nulls for what does not fit.
    """
    shape = schema or ddl(FEED)
    if record:
        # A Parquet file has no such column, and reads as null.
        shape += f", {RECORD} string"
    reader = (
        spark.readStream.schema(shape)
        .format(fmt)
        .option("pathGlobFilter", GLOBS[fmt])
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        if record:
            reader = reader.option("columnNameOfCorruptRecord", RECORD)
    return reader.load(ensure_folder(spark, path))


def all_feeds(spark: SparkSession, path: str, **limits) -> DataFrame:
    """CSV and Parquet files of one folder as one stream, with one checkpoint and one sink."""
    csv, parquet = (feed_stream(spark, path, fmt, **limits) for fmt in GLOBS)
    return csv.unionByName(parquet)


def file_stream(
    spark: SparkSession, path: str, fmt: str, *, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the ``path`` of a folder's files of one format; their contents are not read."""
    shape = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(shape)
    reader = reader.option("pathGlobFilter", GLOBS[fmt])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(ensure_folder(spark, path)).select("path")
