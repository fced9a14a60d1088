"""The streaming job: feed files to the ride table, and what it leaves beside that table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.operators.clean import clean, judged, kept_rides, rejected_rows
from tripflow.operators.enrich import enrich, zones_fit_broadcast
from tripflow.operators.rollup import ride_rollup
from tripflow.schemas import BATCH_COUNTS, FEED, FEED_FILE_TYPES, RECORD, REJECTS, ddl
from tripflow.sources.files import read_rides
from tripflow.sources.folders import matching
from tripflow.sources.footers import footers, misfits, read_group, type_groups
from tripflow.streaming.feeds import file_stream
from tripflow.streaming.sinks import (
    append_batches,
    batch_folder,
    batch_writer,
    query_id,
    refuse_other_layouts,
)


def ride_stream(feed: DataFrame, zones: DataFrame) -> DataFrame:
    """Rides of a feed stream: the batch rules, and stream-static joins to the zones."""
    return enrich(clean(feed), zones)


def publish_zones(zones: DataFrame, folder: str, version: int) -> None:
    """Adds a version of the zone dimension; it counts once it is written whole."""
    zones.write.mode("errorifexists").parquet(f"{folder.rstrip('/')}/version={version:012d}")


class ZoneVersions:
    """A zone dimension that changes: the newest version of a folder, looked up per batch.

    A version is read and measured when it is first met.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.path = ""
        self.known: tuple[DataFrame, bool] | None = None

    def current(self) -> tuple[DataFrame, bool]:
        """The zones, and whether they may be broadcast."""
        written = matching(self.spark, f"{self.folder}/version=*/_SUCCESS")
        if not written:
            raise FileNotFoundError(f"no version of the zones in {self.folder}")
        newest = max(written).rsplit("/", 1)[0]
        if self.known is None or newest != self.path:
            zones = self.spark.read.parquet(newest)
            self.path, self.known = newest, (zones, zones_fit_broadcast(zones))
        return self.known


@dataclass(frozen=True)
class Beside:
    """Tables that the job keeps beside the rides, each written per batch, where named.

    ``rollup``: sums for reports. ``rejects``: the rows that are no rides, with the rule they fail.
    ``counts``: rows that arrived, were kept and were rejected.
    """

    rollup: str | None = None
    rejects: str | None = None
    counts: str | None = None

    @property
    def judges(self) -> bool:
        """Whether rows that are no rides are of use."""
        return bool(self.rejects or self.counts)

    def names(self) -> list[str]:
        return [name for name in (self.rollup, self.rejects, self.counts) if name]


def ride_writer(
    zones: DataFrame | ZoneVersions,
    table: str,
    checkpoint: str,
    beside: Beside,
    cleaned: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch of feed rows to the ride table and to the tables beside it.

    ``cleaned`` if the rows went through ``clean`` already.
    """
    if isinstance(zones, ZoneVersions):
        current = zones.current
    else:
        measured = zones, zones_fit_broadcast(zones)
        current = lambda: measured
    rides_to = batch_writer(table, checkpoint)
    others = {
        name: batch_writer(place, checkpoint)
        for name in ("rollup", "rejects", "counts")
        if (place := getattr(beside, name))
    }

    def write_rides(rides: DataFrame, batch_id: int) -> None:
        dimension, small = current()
        rides_to(enrich(rides, dimension, small=small), batch_id)
        if "rollup" in others:
            spark = rides.sparkSession
            own = batch_folder(table, query_id(spark, checkpoint), batch_id)
            others["rollup"](ride_rollup(read_rides(spark, own)), batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not beside.judges:
            write_rides(batch if cleaned else clean(batch.drop(RECORD)), batch_id)
            return
        # The batch's files are read once; both tables are written from what was judged.
        rows = judged(batch).persist()
        try:
            counted = {name: Observation(name) for name in ("kept", "rejected")}
            one = F.count(F.lit(1)).alias("rows")
            write_rides(kept_rides(rows).observe(counted["kept"], one), batch_id)
            rejected = _rejects(rows).observe(counted["rejected"], one)
            if "rejects" in others:
                others["rejects"](rejected, batch_id)
            else:
                rejected.write.format("noop").mode("overwrite").save()
            if "counts" in others:
                kept, lost = (counted[name].get["rows"] for name in ("kept", "rejected"))
                row = [(kept + lost, kept, lost)]
                totals = batch.sparkSession.createDataFrame(row, ddl(BATCH_COUNTS))
                others["counts"](totals, batch_id)
        finally:
            rows.unpersist()

    return write


def _rejects(rows: DataFrame) -> DataFrame:
    found = rejected_rows(rows)
    if RECORD not in found.columns:
        found = found.withColumn(RECORD, F.lit(None).cast("string"))
    return found.select(*REJECTS)


def start_rides(
    feed: DataFrame,
    zones: DataFrame | ZoneVersions,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    rollup: str | None = None,
    rejects: str | None = None,
    counts: str | None = None,
) -> StreamingQuery:
    """Starts the query that cleans a feed stream into a ride table, exactly once.

    Every micro-batch overwrites the partition of its query and ``batch_id``, whatever the size
    of the zone dimension; that size only decides how a batch is joined. So several queries, or
    one after another with new checkpoints, may fill one table. ``rollup``, ``rejects`` and
    ``counts`` name tables to keep beside it (see ``Beside``), so that reports, audits and a live
    count need not read the rides. A table that was written in another way is refused before any
    file is read.
    """
    beside = Beside(rollup, rejects, counts)
    for name in (table, *beside.names()):
        refuse_other_layouts(feed.sparkSession, name)
    # Where rejects are not asked for, the rules reach the scan.
    rows = feed if beside.judges else clean(feed.drop(RECORD))
    write = ride_writer(zones, table, checkpoint, beside, cleaned=not beside.judges)
    return append_batches(rows, table, checkpoint, trigger, write)


def start_checked_rides(
    spark: SparkSession,
    path: str,
    zones: DataFrame | ZoneVersions,
    table: str,
    checkpoint: str,
    dead_letters: str,
    trigger: dict | None = None,
    files_per_trigger: int = 10_000,
    beside: Beside | None = None,
) -> StreamingQuery:
    """Like ``start_rides`` over Parquet files that need not all fit: a gate before the decoding.

    The stream is one of file names. A batch's footers are read first; files that are no Parquet
    files, lack a column or have a type that cannot stand for the declared one are listed in
    ``dead_letters`` with the reason, and the stream goes on with the others, each group of
    equal types read by its own. A file that is listed is not tried again; deliver it anew.
    """
    beside = beside or Beside()
    for name in (table, dead_letters, *beside.names()):
        refuse_other_layouts(spark, name)
    write_rides = ride_writer(zones, table, checkpoint, beside)
    write_dead = batch_writer(dead_letters, checkpoint)
    fits = {name: FEED_FILE_TYPES[kind] for name, kind in FEED.items()}

    def write(names: DataFrame, batch_id: int) -> None:
        found = footers(names)
        bad = misfits(found, FEED, fits)
        write_dead(bad, batch_id)
        groups = type_groups(found.join(bad.select("path"), "path", "left_anti"), FEED)
        # The session of the batch, whose settings the stream fixed.
        session = names.sparkSession
        parts = [read_group(session, paths, FEED) for _, paths in groups]
        if parts:
            write_rides(reduce(DataFrame.unionByName, parts), batch_id)

    files = file_stream(spark, path, "parquet", files_per_trigger=files_per_trigger)
    return append_batches(files, table, checkpoint, trigger, write)
