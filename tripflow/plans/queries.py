"""The registered queries: one per operator, each over whole tables of a folder.

NaN fares are shown as a flag beside a null, since NaN does not compare equal to itself. Only the
mean predictor's error is rounded: it comes from a variance, whose order of adding is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import clean as cleaning
from tripflow.operators import display, enrich, metrics, normalize, sampling
from tripflow.operators import requests as fare_requests
from tripflow.plans import events, fares
from tripflow.schemas import (
    BATCH_COUNTS,
    DEAD_LETTERS,
    FEED,
    LABEL,
    PREDICTION,
    REJECTS,
    REQUESTS,
    RIDES,
    TRIP,
    ddl,
)
from tripflow.sources import files, footers
from tripflow.sources.folders import ensure_folder, run_folder
from tripflow.streaming import feeds, sinks
from tripflow.streaming.rides import (
    ZoneVersions,
    publish_zones,
    start_checked_rides,
    start_rides,
)

KEY = events.KEY
REQUEST_KEY = ("request_id",)
SAMPLE_ROWS = 5_000
#: Small, so that a small table makes several files as well.
FEED_ROWS_PER_FILE = 2_500
DELIVERIES = 4
#: Feeds that are streamed side by side where every file is a micro-batch.
LANES = 8


def _show_nan(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "fare_is_nan": F.coalesce(F.isnan("fare_amount"), F.lit(False)),
            "fare_amount": F.nanvl("fare_amount", F.lit(None).cast("double")),
        }
    )


# --- Sources ---------------------------------------------------------------------------------


def scan_trips(spark: SparkSession, folder: str) -> DataFrame:
    return _show_nan(events.trips(spark, folder))


def scan_zones(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "zones")
    events.zones(spark, folder).write.option("header", True).csv(path)
    return files.read_zones(spark, path)


#: The types that some files of a mixed history have in place of the declared ones.
OTHER_TYPES = (
    {"passenger_count": "double", "payment_type": "int", "PULocationID": "int"},
    {"passenger_count": "string", "trip_distance": "decimal(10, 1)", "payment_type": "double"},
)


def scan_mixed_history(spark: SparkSession, folder: str) -> DataFrame:
    """Months whose files have different types for a column, read as one table."""
    path = run_folder(spark, "history")
    trips = events.trips(spark, folder)
    for number, types in enumerate(({}, *OTHER_TYPES)):
        month = trips.filter(F.pmod("trip_id", F.lit(3)) == number)
        casts = {name: F.col(name).cast(kind) for name, kind in types.items()}
        month.withColumns(casts).write.mode("append").parquet(path)
    return _show_nan(footers.read_history(spark, path, TRIP))


def zone_list(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.zone_list(events.zones(spark, folder))


def feed_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the feed files, each with whether its place in its file is below the limit."""
    path = run_folder(spark, "feed")
    files.write_feed(events.feed(spark, folder).select(*FEED), path, FEED_ROWS_PER_FILE)
    within = F.col("_metadata.row_index") < FEED_ROWS_PER_FILE
    return _show_nan(
        spark.read.schema(ddl(FEED)).parquet(path).withColumn("within_limit", within)
    )


# --- Normalisation ---------------------------------------------------------------------------


def rename_trips(spark: SparkSession, folder: str) -> DataFrame:
    return _show_nan(normalize.rename_trips(events.trips(spark, folder)))


def normalize_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _show_nan(normalize.normalize_feed(events.trips(spark, folder), key=KEY))


def payment_labels(spark: SparkSession, folder: str) -> DataFrame:
    trips = events.trips(spark, folder)
    coded = trips.select(*KEY, F.col("payment_type").alias("payment_code"), "payment_type")
    return normalize.label_payments(coded)


def malformed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _show_nan(normalize.malformed_rows(events.trips(spark, folder), key=KEY))


# --- Cleaning --------------------------------------------------------------------------------


def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_missing(events.feed(spark, folder))


def positive_fare(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.positive_fare(drop_missing(spark, folder))


def positive_distance(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.positive_distance(drop_missing(spark, folder))


def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.parse_times(events.feed(spark, folder)).select(*KEY, *cleaning.TIMES)


def ride_duration(spark: SparkSession, folder: str) -> DataFrame:
    timed = cleaning.with_duration(cleaning.parse_times(events.feed(spark, folder)))
    return timed.select(*KEY, "ride_duration_minutes")


def pickup_hour(spark: SparkSession, folder: str) -> DataFrame:
    timed = cleaning.with_pickup_hour(cleaning.parse_times(events.feed(spark, folder)))
    return timed.select(*KEY, "pickup_hour")


def clean_rides(spark: SparkSession, folder: str) -> DataFrame:
    return events.named_rides(spark, folder)


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.reject_reasons(events.feed(spark, folder))


# --- Joins -----------------------------------------------------------------------------------


def join_pickup_zone(spark: SparkSession, folder: str) -> DataFrame:
    rides = events.rides(spark, folder).select(*KEY, "pickup_location_id")
    return enrich.enrich(rides, events.zones(spark, folder), ("pickup",))


def join_dropoff_zone(spark: SparkSession, folder: str) -> DataFrame:
    rides = events.rides(spark, folder).select(*KEY, "dropoff_location_id")
    return enrich.enrich(rides, events.zones(spark, folder), ("dropoff",))


def join_large_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The join for a dimension beyond the broadcast bound, on the same tables."""
    rides = events.rides(spark, folder).select(*KEY, "pickup_location_id")
    return enrich.enrich(rides, events.zones(spark, folder), ("pickup",), small=False)


# --- Reports ---------------------------------------------------------------------------------


def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.kpi_summary(events.rides(spark, folder))


def kpi_display(spark: SparkSession, folder: str) -> DataFrame:
    return display.kpi_display(metrics.kpi_summary(events.rides(spark, folder)))


def live_incoming(spark: SparkSession, folder: str) -> DataFrame:
    """Rides that came in on the last day of the table.

    Both snapshots are sums over the same daily counts, so the rides are scanned once. The
    earlier one sets the last day's count to 0: a filter would be pushed into a second scan.
    """
    day = F.to_date("pickup_datetime").alias("day")
    daily = events.rides(spark, folder).groupBy(day).agg(F.count(F.lit(1)).alias("trips"))
    last_day = daily.agg(F.max(F.when(F.col("trips") > 0, F.col("day")))).scalar()
    earlier = F.when(F.col("day") < last_day, F.col("trips")).otherwise(0)
    return metrics.live_incoming(daily, daily.withColumn("trips", earlier))


def avg_tip(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.average_tip(events.rides(spark, folder))


def trips_per_hour(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.trips_per_hour(events.rides(spark, folder))


def peak_hour(spark: SparkSession, folder: str) -> DataFrame:
    return display.peak_hour_display(metrics.peak_hour(events.rides(spark, folder)))


def payment_mix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.payment_mix(events.rides(spark, folder))


def trips_per_zone(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.trips_per_zone(events.rides(spark, folder), events.zones(spark, folder))


def busiest_zone(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.busiest_zone(events.rides(spark, folder), events.zones(spark, folder))


def top_pickup_zones(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.top_pickup_zones(events.rides(spark, folder), events.zones(spark, folder))


def trips_by_borough(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.trips_by_borough(events.rides(spark, folder), events.zones(spark, folder))


def avg_fare_by_hour_sql(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.average_fare_by_hour(events.rides(spark, folder))


def _recent(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.recent_rides(
        events.rides(spark, folder), events.zones(spark, folder), tie_break=KEY
    )


def recent_rides(spark: SparkSession, folder: str) -> DataFrame:
    return _recent(spark, folder)


def recent_rides_display(spark: SparkSession, folder: str) -> DataFrame:
    return display.recent_rides_display(_recent(spark, folder))


def fare_per_mile(spark: SparkSession, folder: str) -> DataFrame:
    """Over the feed, where distances may still be 0."""
    feed = cleaning.drop_missing(events.feed(spark, folder))
    return metrics.with_fare_per_mile(feed).select(*KEY, "fare_per_mile")


# --- Streams ---------------------------------------------------------------------------------


def _drain(rows: DataFrame, schema: str) -> DataFrame:
    """Runs a stream over the files that are there and returns the table it wrote."""
    spark = rows.sparkSession
    table = run_folder(spark, "table")
    checkpoint = run_folder(spark, "checkpoint")
    sinks.run_available(sinks.append_stream(rows, table, checkpoint, sinks.AVAILABLE_NOW))
    return spark.read.schema(schema).parquet(table)


def _feed_folder(spark: SparkSession, folder: str, *formats: str) -> str:
    path = run_folder(spark, "feed")
    for fmt in formats:
        feed = events.feed(spark, folder).select(*FEED)
        files.write_feed(feed, path, FEED_ROWS_PER_FILE, fmt)
    return path


def stream_csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = _feed_folder(spark, folder, "csv")
    return _show_nan(_drain(feeds.feed_stream(spark, path, "csv"), ddl(FEED)))


def stream_parquet_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Streams the events table in place and normalises it on the way.

    A file stream takes a folder or a wildcard but not the path of one file, and the table may be
    either; the wildcard matches just its name.
    """
    table = f"{folder}/event[s].parquet"
    stream = feeds.feed_stream(spark, table, "parquet", schema=events.EVENTS)
    rows = normalize.normalize_feed(events.trips_of(stream))
    return _show_nan(_drain(rows, ddl(FEED)))


def stream_union_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """The whole feed once as CSV and once as Parquet, into one table."""
    path = _feed_folder(spark, folder, "csv", "parquet")
    return _show_nan(_drain(feeds.all_feeds(spark, path), ddl(FEED)))


def stream_clean_rides(spark: SparkSession, folder: str) -> DataFrame:
    feed = feeds.feed_stream(spark, _feed_folder(spark, folder, "parquet"), "parquet")
    table = run_folder(spark, "rides")
    query = start_rides(
        feed,
        events.zones(spark, folder),
        table,
        run_folder(spark, "checkpoint"),
        sinks.AVAILABLE_NOW,
    )
    sinks.run_available(query)
    return files.read_rides(spark, table)


def _deliver(
    spark: SparkSession,
    folder: str,
    table: str,
    rows_of: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Delivers the trips in ``DELIVERIES`` parts by id to one stream, restarted after each.

    A part is all that the feed folder gained since the last commit, and so one micro-batch,
    however many files and splits it has.
    """
    path = run_folder(spark, "trips")
    checkpoint = run_folder(spark, "checkpoint")
    trips = events.trips(spark, folder)
    for number in range(DELIVERIES):
        part = trips.filter(F.pmod("trip_id", F.lit(DELIVERIES)) == number)
        files.write_feed(part, path, FEED_ROWS_PER_FILE)
        arrived = rows_of(feeds.feed_stream(spark, path, "parquet", schema=ddl(TRIP)))
        sinks.run_available(
            sinks.append_batches(arrived, table, checkpoint, sinks.AVAILABLE_NOW, write)
        )


def stream_batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = run_folder(spark, "batches")
    _deliver(spark, folder, table, lambda trips: trips)
    return sinks.arrivals(sinks.read_batches(spark, table, ddl(TRIP)))


def _stored_rides(spark: SparkSession, table: str) -> DataFrame:
    stored = {name: kind for name, kind in RIDES.items() if not name.endswith("_zone")}
    return sinks.read_batches(spark, table, f"trip_id bigint, {ddl(stored)}").drop(*sinks.BATCH)


def _rides_of_trips(trips: DataFrame) -> DataFrame:
    return cleaning.clean(normalize.normalize_feed(trips, key=KEY))


class _LostCommit(Exception):
    """Stands for a driver that is lost after a write and before the commit."""


def stream_one_file_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Under a limit of one file per trigger, the rows of each batch by the file they came in.

    A micro-batch has a cost that does not depend on its rows, and here there are as many as files.
    So the trips are dealt to ``LANES`` feeds, whose streams fill one table side by side.
    """
    path, table = run_folder(spark, "trips"), ensure_folder(spark, run_folder(spark, "batches"))
    lane = F.pmod(F.hash("trip_id"), F.lit(LANES))
    trips = events.trips(spark, folder).withColumn("lane", lane)
    files.write_feed(trips, path, FEED_ROWS_PER_FILE, by=("lane",))
    queries = []
    for number in range(LANES):
        feed = feeds.feed_stream(
            spark, f"{path}/lane={number}", "parquet", files_per_trigger=1, schema=ddl(TRIP)
        )
        named = feed.withColumn("file", F.col("_metadata.file_name"))
        checkpoint = run_folder(spark, "checkpoint")
        queries.append(sinks.append_batches(named, table, checkpoint, sinks.AVAILABLE_NOW))
    sinks.run_together(queries)
    rows = sinks.read_batches(spark, table, f"{ddl(TRIP)}, file string")
    per_batch = rows.groupBy(*sinks.BATCH).agg(
        F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows")
    )
    return per_batch.groupBy("files").agg(
        F.sum("rows").alias("rows"), (F.max("rows") <= FEED_ROWS_PER_FILE).alias("within_limit")
    )


def stream_replay_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The query is lost after each micro-batch's write, before its commit, and started again."""
    table, checkpoint = run_folder(spark, "batches"), run_folder(spark, "checkpoint")
    lost: set[int] = set()
    store = sinks.batch_writer(table, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id not in lost:
            lost.add(batch_id)
            raise _LostCommit

    path = run_folder(spark, "trips")
    trips = events.trips(spark, folder)
    for number in range(DELIVERIES):
        part = trips.filter(F.pmod("trip_id", F.lit(DELIVERIES)) == number)
        files.write_feed(part, path, FEED_ROWS_PER_FILE)
        rows = _rides_of_trips(feeds.feed_stream(spark, path, "parquet", schema=ddl(TRIP)))
        for attempt in range(2):
            query = sinks.append_batches(rows, table, checkpoint, sinks.AVAILABLE_NOW, write)
            try:
                sinks.run_available(query)
            except StreamingQueryException:
                if attempt:
                    raise
    return _stored_rides(spark, table)


def stream_two_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Two feeds, each with a checkpoint of its own, into one table: both loads stay."""
    table = run_folder(spark, "batches")
    trips = events.trips(spark, folder)
    for number in range(2):
        path = run_folder(spark, "trips")
        part = trips.filter(F.pmod("trip_id", F.lit(2)) == number)
        files.write_feed(part, path, FEED_ROWS_PER_FILE)
        rows = _rides_of_trips(feeds.feed_stream(spark, path, "parquet", schema=ddl(TRIP)))
        checkpoint = run_folder(spark, "checkpoint")
        sinks.run_available(
            sinks.append_batches(rows, table, checkpoint, sinks.AVAILABLE_NOW)
        )
    return _stored_rides(spark, table)


def _record_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed rows as text, some with words where numbers belong."""
    feed = events.feed(spark, folder).filter("not isnan(fare_amount)")
    texts = feed.select("trip_id", *[F.col(name).cast("string").alias(name) for name in FEED])
    return texts.withColumns(
        {
            "tip_amount": F.expr("if(trip_id % 31 = 0, 'abc', tip_amount)"),
            "trip_distance": F.expr("if(trip_id % 37 = 0, 'far', trip_distance)"),
        }
    ).drop("trip_id")


def stream_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Records that do not fit their types, by the fields of their text, and all other rejects."""
    path, table = run_folder(spark, "feed"), run_folder(spark, "rides")
    files.write_feed(_record_feed(spark, folder), path, FEED_ROWS_PER_FILE, "csv")
    rejects = run_folder(spark, "rejects")
    query = start_rides(
        feeds.feed_stream(spark, path, "csv", record=True),
        events.zones(spark, folder),
        table,
        run_folder(spark, "checkpoint"),
        sinks.AVAILABLE_NOW,
        rejects=rejects,
    )
    sinks.run_available(query)
    fields = F.split("record", ",", -1)
    place = {name: at for at, name in enumerate(FEED)}
    own = ("pickup_datetime", "trip_distance", "tip_amount", "payment_type")
    texts = {name: F.get(fields, F.lit(place[name])) for name in own}
    # Engines write doubles in different ways.
    readable = F.expr("try_cast(split(record, ',', -1)[6] as double) is not null")
    texts["tip_amount"] = F.when(readable, "number").otherwise(texts["tip_amount"])
    shown = [text.alias(f"{name}_text") for name, text in texts.items()]
    rows = sinks.read_batches(spark, rejects, ddl(REJECTS))
    # Of rows whose record is fine, the text is null and so are its fields.
    return rows.select("reason", *shown).groupBy("reason", *[f"{n}_text" for n in own]).agg(
        F.count(F.lit(1)).alias("trips")
    )


def _deliver_feed(spark: SparkSession, folder: str, start: Callable, before: Callable) -> None:
    """Feed rows in ``DELIVERIES`` parts, each one micro-batch of a query that ``start`` makes."""
    path = run_folder(spark, "feed")
    feed = events.feed(spark, folder)
    for number in range(DELIVERIES):
        before(number)
        part = feed.filter(F.pmod("trip_id", F.lit(DELIVERIES)) == number)
        files.write_feed(part.select(*FEED), path, FEED_ROWS_PER_FILE)
        sinks.run_available(start(feeds.feed_stream(spark, path, "parquet")))


def _rides_beside(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The feed in parts; names of the tables of rejects and of counts."""
    names = [run_folder(spark, name) for name in ("rides", "checkpoint", "rejects", "counts")]
    table, checkpoint, rejects, counts = names
    zones = events.zones(spark, folder)
    beside = {"rejects": rejects, "counts": counts}
    _deliver_feed(
        spark,
        folder,
        lambda feed: start_rides(
            feed, zones, table, checkpoint, sinks.AVAILABLE_NOW, **beside
        ),
        lambda number: None,
    )
    return rejects, counts


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What each micro-batch rejected, by the first rule a row fails."""
    rejects, _ = _rides_beside(spark, folder)
    rows = sinks.read_batches(spark, rejects, ddl(REJECTS))
    return rows.groupBy("batch_id", "reason").agg(F.count(F.lit(1)).alias("trips"))


def stream_batch_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that arrived, were kept and were rejected per micro-batch, as observed on the way."""
    _, counts = _rides_beside(spark, folder)
    return sinks.read_batches(spark, counts, ddl(BATCH_COUNTS)).drop("query_id")


def stream_zone_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Rides per batch and pickup zone; half-way, every zone gets another name."""
    versions = run_folder(spark, "zones")
    table, checkpoint = run_folder(spark, "rides"), run_folder(spark, "checkpoint")
    zones = events.zones(spark, folder)
    renamed = zones.withColumn("Zone", F.concat(F.lit("New "), "Zone"))
    dimension = ZoneVersions(spark, versions)

    def publish(number: int) -> None:
        if number in (0, DELIVERIES // 2):
            publish_zones(renamed if number else zones, versions, number)

    _deliver_feed(
        spark,
        folder,
        lambda feed: start_rides(feed, dimension, table, checkpoint, sinks.AVAILABLE_NOW),
        publish,
    )
    rides = sinks.read_batches(spark, table, ddl(RIDES))
    return rides.groupBy("batch_id", "pickup_zone").agg(F.count(F.lit(1)).alias("trips"))


def stream_checked_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rides from files of which some do not fit, and why those were set aside.

    A quarter of the trips come with another type that fits, a quarter with one that does not,
    and a quarter without a column.
    """
    path, table = run_folder(spark, "feed"), run_folder(spark, "rides")
    feed = events.feed(spark, folder).withColumn("part", F.pmod("trip_id", F.lit(4)))
    shapes = (
        lambda rows: rows,
        lambda rows: rows.withColumn("passenger_count", F.col("passenger_count").cast("double")),
        lambda rows: rows.withColumn("fare_amount", F.col("fare_amount").cast("string")),
        lambda rows: rows.drop("tip_amount"),
    )
    for number, shape in enumerate(shapes):
        rows = feed.filter(F.col("part") == number).select(*FEED)
        shape(rows).write.mode("append").parquet(path)
    dead = run_folder(spark, "dead-letters")
    query = start_checked_rides(
        spark,
        path,
        events.zones(spark, folder),
        table,
        run_folder(spark, "checkpoint"),
        dead,
        sinks.AVAILABLE_NOW,
    )
    sinks.run_available(query)
    letters = sinks.read_batches(spark, dead, ddl(DEAD_LETTERS))
    rides = files.read_rides(spark, table).groupBy("pickup_zone").agg(F.count("*").alias("trips"))
    return (
        rides.select(F.lit("ride").alias("kind"), F.col("pickup_zone").alias("name"), "trips")
        .unionByName(
            letters.select("reason")
            .distinct()
            .select(F.lit("set aside").alias("kind"), F.col("reason").alias("name"))
            .withColumn("trips", F.lit(None).cast("long"))
        )
    )


# --- Sampling and the fare model -------------------------------------------------------------


def training_sample(spark: SparkSession, folder: str) -> DataFrame:
    rides = events.rides(spark, folder)
    return sampling.training_sample(rides, list(KEY), SAMPLE_ROWS).select(*KEY, LABEL)


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.with_split(events.rides(spark, folder), list(KEY)).select(*KEY, "split")


def rmse_baseline(spark: SparkSession, folder: str) -> DataFrame:
    marked = sampling.with_split(events.rides(spark, folder), list(KEY))
    return metrics.mean_predictor_rmse(marked).withColumn("rmse", F.round("rmse", 6))


def _training_rides(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enrich(
        fares.training_rides(events.trips(spark, folder)), events.zones(spark, folder)
    )


def zone_index(spark: SparkSession, folder: str) -> DataFrame:
    return fares.index_zones(events.named_rides(spark, folder)).select(*KEY, *fares.INDEXES)


def training_features(spark: SparkSession, folder: str) -> DataFrame:
    return fares.training_features(_training_rides(spark, folder), list(KEY))


def valid_requests(spark: SparkSession, folder: str) -> DataFrame:
    return fare_requests.valid_requests(events.requests(spark, folder))


def request_features(spark: SparkSession, folder: str) -> DataFrame:
    return fare_requests.request_features(events.requests(spark, folder))


def _trained(spark: SparkSession, folder: str) -> fares.FareTraining:
    return fares.train_fare_model(
        events.trips(spark, folder),
        events.zones(spark, folder),
        run_folder(spark, "sample"),
        key=list(KEY),
    )


def _within(prediction: str, train: DataFrame) -> Column:
    """Whether a prediction lies among the train part's labels, as a forest's means must.

    Means are sums of doubles, so the ends have a tolerance.
    """
    low = train.agg(F.min(LABEL) - 1e-6).scalar()
    high = train.agg(F.max(LABEL) + 1e-6).scalar()
    return F.col(prediction).between(low, high)


def fare_model_rmse(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the whole test part, and how the forest's error compares.

    These fares are drawn independently of the trips' features, so no model can beat the mean by
    more than chance; one that leaks or diverges leaves the band around it.
    """
    training = _trained(spark, folder)
    scored = training.model.transform(training.test)
    forest = metrics.root_mean_squared_error(scored, LABEL, PREDICTION)
    parts = training.train.select(LABEL, F.lit("train").alias("split")).unionByName(
        scored.select(LABEL, F.lit("test").alias("split"))
    )
    ratio = forest.scalar() / F.col("rmse")
    return metrics.mean_predictor_rmse(parts).select(
        "test_rows", ratio.between(0.75, 1.25).alias("near_mean_predictor")
    )


def fare_model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Every complete ride of the test part, and whether its prediction is a possible one."""
    training = _trained(spark, folder)
    within = _within(PREDICTION, training.train).alias("within_train_range")
    return training.model.transform(training.test).select(*KEY, LABEL, within)


def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every request with its card, apart from the forest's number, which SQL cannot state."""
    training = _trained(spark, folder)
    scored = fares.score_fares(events.requests(spark, folder), training.model)
    distance = F.col("trip_distance")
    per_mile = F.when(distance != 0, F.col(PREDICTION) / distance).otherwise(F.lit(0.0))
    return display.fare_card(scored).select(
        *REQUEST_KEY,
        *REQUESTS,
        "ride_duration_minutes",
        _within(PREDICTION, training.train).alias("within_train_range"),
        F.col("fare_per_mile").eqNullSafe(per_mile).alias("per_mile_agrees"),
        F.col("fare_text").startswith("$").alias("has_fare_text"),
        "hour_text",
    )


# --- The model's own numbers, which SQL cannot state -------------------------------------------


def fare_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of the forest and of the mean over the whole test part."""
    training = _trained(spark, folder)
    scored = training.model.transform(training.test)
    parts = training.train.select(LABEL, F.lit("train").alias("split")).unionByName(
        scored.select(LABEL, F.lit("test").alias("split"))
    )
    mean = metrics.mean_predictor_rmse(parts).withColumnRenamed("rmse", "mean_rmse")
    forest = metrics.root_mean_squared_error(scored, LABEL, PREDICTION).scalar()
    return mean.withColumn("forest_rmse", forest)


def fare_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The fare and its prediction for every complete ride of the test part."""
    training = _trained(spark, folder)
    return training.model.transform(training.test).select(*KEY, LABEL, PREDICTION)


def scored_fares(spark: SparkSession, folder: str) -> DataFrame:
    """Every request with its predicted fare, as a card."""
    scored = fares.score_fares(events.requests(spark, folder), _trained(spark, folder).model)
    return display.fare_card(scored)
