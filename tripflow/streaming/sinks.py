"""Writing a stream to a Parquet table exactly once.

``append_stream`` is the default: the file sink's log decides which files count. Where rows must
show which micro-batch brought them, ``append_batches`` writes each batch to a partition of its
query and batch and overwrites that partition when the batch is run again, so a crash between
write and commit leaves no duplicates. A query is known by the id in its checkpoint: it stays over
restarts, and a new checkpoint, which counts batches from 0 again, or a second query into the same
table has another. Do not point both kinds of writer at one table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.sources.folders import has_sink_log, matching

#: Partition columns of a table that micro-batches are written to.
BATCH = ("query_id", "batch_id")
AVAILABLE_NOW = {"availableNow": True}


def append_stream(
    rows: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Starts a query that appends rows to a table through the file sink.

    Without ``trigger`` micro-batches follow each other as fast as they can.
    """
    writer = (
        rows.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query whose checkpoint this is."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first().id


def batch_folder(table: str, query: str, batch_id: int) -> str:
    """Where one micro-batch of a query lies."""
    return f"{table.rstrip('/')}/query_id={query}/batch_id={batch_id}"


def batch_writer(table: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch over its own partition of the table, in one job.

    An empty batch has no rows for any partition and so writes no file; asking ``isEmpty`` first
    would read the batch's files a second time. The id is a text here, since a number would be
    part of the generated code, which then is compiled anew for every batch.
    """
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(query_id(batch.sparkSession, checkpoint))
        (
            batch.withColumns({"query_id": F.lit(known[0]), "batch_id": F.lit(str(batch_id))})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*BATCH)
            .parquet(table)
        )

    return write


def refuse_other_layouts(spark: SparkSession, table: str) -> None:
    """Raises for a table that ``batch_writer`` must not add to, before any file is read."""
    if has_sink_log(spark, table):
        raise ValueError(f"{table} was written by a file sink; rewrite it with compact first")
    if matching(spark, f"{table.rstrip('/')}/batch_id=*"):
        raise ValueError(f"{table} has batches without their query; rewrite it with compact first")


def append_batches(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    write: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Starts a query that writes each micro-batch to a partition of its own.

    ``write`` may stand in for the writer of ``batch_writer``.
    """
    writer = (
        rows.writeStream.foreachBatch(write or batch_writer(table, checkpoint))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_available(query: StreamingQuery) -> StreamingQuery:
    """Waits for an ``availableNow`` query to work through what is there."""
    query.awaitTermination()
    return query


def run_together(queries: list[StreamingQuery]) -> None:
    """Waits for ``availableNow`` queries that run side by side; if one fails, stops the others."""
    try:
        for query in queries:
            run_available(query)
    finally:
        for query in queries:
            query.stop()


def read_batches(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """A table of ``append_batches``, with ``query_id`` and ``batch_id`` from its folder names."""
    return spark.read.schema(f"{schema}, query_id string, batch_id bigint").parquet(table)


def arrivals(batches: DataFrame, *by: str) -> DataFrame:
    """Rows that each micro-batch brought; by ``*BATCH`` where several queries fill a table."""
    return batches.groupBy(*(by or ("batch_id",))).agg(F.count(F.lit(1)).alias("arrivals"))
