"""Command line: ``spark-submit`` this file, or ``python -m tripflow.jobs``, with a job's name.

Spark's settings are the submitter's; paths are arguments and may be on any file system.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.display import fare_card
from tripflow.operators.metrics import average_fare_by_hour
from tripflow.operators.normalize import normalize_feed
from tripflow.operators.requests import rejected_requests, valid_requests
from tripflow.plans import fares, reports
from tripflow.schemas import FOREST_DEPTH, FOREST_TREES, TRAINING_SAMPLE_ROWS, TRIP
from tripflow.sources import files
from tripflow.sources.folders import matching, run_folder
from tripflow.sources.footers import read_history
from tripflow.streaming import feeds, sinks
from tripflow.streaming.rides import Beside, ZoneVersions, start_checked_rides, start_rides


def _history(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Historical trips; file by file where their types differ."""
    if args.mixed_types:
        return read_history(spark, args.trips, TRIP)
    return files.read_trips(spark, args.trips)


def _zones(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The zone dimension, if there is one."""
    if not path or not matching(spark, path):
        return None
    return files.read_zones(spark, path)


def feed(spark: SparkSession, args: argparse.Namespace) -> None:
    """Normalise historical trips into feed files."""
    rows = normalize_feed(_history(spark, args))
    files.write_feed(rows, args.feed, args.rows_per_file, args.format)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Clean the CSV and Parquet files of a feed folder into the ride table, as they come."""
    trigger = sinks.AVAILABLE_NOW if args.available_now else None
    if args.zone_versions:
        zones = ZoneVersions(spark, args.zones)
    else:
        zones = files.read_zones(spark, args.zones)
    place = (zones, args.rides, args.checkpoint)
    beside = Beside(args.rollup, args.rejects, args.counts)
    if args.dead_letters:
        limit = {"files_per_trigger": args.files_per_trigger} if args.files_per_trigger else {}
        query = start_checked_rides(
            spark, args.feed, *place, args.dead_letters, trigger, beside=beside, **limit
        )
    else:
        rows = feeds.all_feeds(
            spark,
            args.feed,
            files_per_trigger=args.files_per_trigger,
            bytes_per_trigger=args.bytes_per_trigger,
            record=beside.judges,
        )
        query = start_rides(rows, *place, trigger, **vars(beside))
    query.awaitTermination()


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print the report pages of a ride table."""
    rides = files.read_rides(spark, args.rides)
    if args.rollup:
        rollup = files.read_rollup(spark, args.rollup)
    else:
        rollup = reports.stored_rollup(rides, run_folder(spark, "rollup"))
    previous = files.read_totals(spark, args.totals) if args.totals else None
    pages = {
        **reports.overview(rollup, previous),
        **reports.analytics(rollup, _zones(spark, args.zones)),
        **reports.latest(rides),
    }
    for name, page in pages.items():
        print(name)
        page.show(args.rows or max(1, page.count()), truncate=False)
    if args.totals:
        files.add_total(rollup, args.totals)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Train the fare model on historical trips, print its error and save it."""
    trips = _history(spark, args)
    training = fares.train_fare_model(
        trips,
        files.read_zones(spark, args.zones),
        run_folder(spark, "training"),
        key=args.key,
        sample_rows=args.sample_rows,
        trees=args.trees,
        depth=args.depth,
    )
    average_fare_by_hour(training.train.unionByName(training.test)).show()
    print(f"Test RMSE: {training.rmse:.2f}")
    fares.save_model(training.model, args.model)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    """Predict the fares of a Parquet table of requests; those out of range go to a second one."""
    requests = spark.read.parquet(args.requests)
    scored = fares.score_fares(valid_requests(requests), fares.load_model(args.model))
    fare_card(scored).write.mode("errorifexists").parquet(args.scores)
    rejects = args.rejects or f"{args.scores.rstrip('/')}-rejected"
    rejected_requests(requests).write.mode("errorifexists").parquet(rejects)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rewrite a ride table of many small files into a new folder."""
    files.compact_rides(spark, args.rides, args.target)


def parser() -> argparse.ArgumentParser:
    main_parser = argparse.ArgumentParser(prog="tripflow", description=__doc__)
    commands = main_parser.add_subparsers(required=True)

    def command(job, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(job.__name__, help=job.__doc__)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        sub.set_defaults(job=job)
        return sub

    mixed = {"action": "store_true", "help": "files differ in the types of their columns"}
    sub = command(feed, "trips", "feed")
    sub.add_argument("--mixed-types", **mixed)
    sub.add_argument("--rows-per-file", type=int, default=1_000_000)
    sub.add_argument("--format", choices=("parquet", "csv"), default="parquet")

    sub = command(stream, "feed", "zones", "rides", "checkpoint")
    sub.add_argument("--files-per-trigger", type=int)
    sub.add_argument("--bytes-per-trigger", type=int)
    sub.add_argument("--available-now", action="store_true", help="stop when the folder is done")
    sub.add_argument("--rollup", help="keep a table of sums for reports, by batch")
    sub.add_argument("--rejects", help="keep the rows that are no rides, with the reason")
    sub.add_argument("--counts", help="keep how many rows arrived, stayed and were rejected")
    sub.add_argument("--dead-letters", help="take Parquet files only, and list those that misfit")
    sub.add_argument(
        "--zone-versions", action="store_true", help="zones is a folder of version=N folders"
    )

    sub = command(report, "rides")
    sub.add_argument("--zones", help="without zones, boroughs are left out")
    sub.add_argument("--rows", type=int, default=0)
    sub.add_argument("--totals", help="keep ride totals, to show what came in since last time")
    sub.add_argument("--rollup", help="read the sums that the stream keeps")

    sub = command(train, "trips", "zones", "model")
    sub.add_argument("--mixed-types", **mixed)
    sub.add_argument("--key", nargs="+", help="columns that identify a trip")
    sub.add_argument("--sample-rows", type=int, default=TRAINING_SAMPLE_ROWS)
    sub.add_argument("--trees", type=int, default=FOREST_TREES)
    sub.add_argument("--depth", type=int, default=FOREST_DEPTH)

    sub = command(score, "requests", "model", "scores")
    sub.add_argument("--rejects", help="folder for requests out of range (<scores>-rejected)")

    command(compact, "rides", "target")
    return main_parser


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.job(SparkSession.builder.appName("tripflow").getOrCreate(), args)


if __name__ == "__main__":
    main()
