"""The jobs as a command, for spark-submit::

    spark-submit --py-files daytally.zip daytally/job.py ingest --root <landing> --lake <lake> --ds 2024-01-05 --schema <ddl>

``check`` prints what has landed for a day, or for any prefix, and the number its size picks; ``ingest`` brings the day's
logs into the lake, and ``stream`` all logs that no run has taken yet; ``load`` appends the day, or ``--all`` of the
lake, to a warehouse table, and ``recluster`` writes its overlapping files anew; ``run`` does the daily run, over several
days with ``--until``, ``correct`` runs one earlier day again and mends the users it changes; ``rebucket`` gives the
cumulative table another number of buckets; ``strays`` prints the objects below the log folder that no job takes.
"""

from __future__ import annotations

import argparse
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.dates import as_day
from daytally.functions.loglines import LineParser, json_lines
from daytally.plans.deltas import DeltaTables
from daytally.plans.ingest import ingest_day
from daytally.plans.load import load_day, load_lake
from daytally.plans.pipeline import backfill, run_day
from daytally.plans.recluster import recluster as recluster_table
from daytally.plans.tables import CalcTables
from daytally.session import configure
from daytally.sources.lake import misplaced, read_events
from daytally.sources.landing import (
    SizeRule,
    input_size_profile,
    landing_gate,
    log_objects,
    prefix_gate,
    size_profile,
    stray_objects,
)
from daytally.streaming.ingest import stream_ingest


def parse_args(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daytally", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str, ds: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--ds", required=ds, type=as_day)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def required_fields(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--required", default="upload_time", help="fields without which a line is a reject, by commas")

    check = job("check", ds=False)
    check.add_argument("--root", help="folder that holds the log folder; with --ds")
    check.add_argument("--prefix", help="any prefix of object paths, instead of a day's logs")
    check.add_argument("--suffix")
    ingest = job("ingest", "root", "lake", "schema")
    ingest.add_argument("--size-rule", action="store_true", help="limit the files written to what the input's size picks")
    required_fields(ingest)
    stream = job("stream", "root", "lake", "schema", "checkpoint", ds=False)
    stream.add_argument("--max-file-age", default="3650d")
    stream.add_argument("--glob", help="log objects to watch, by default those of all days")
    required_fields(stream)
    load = job("load", "lake", "table", "schema", ds=False)
    load.add_argument("--all", action="store_true", help="all days, for a first load")
    load.add_argument("--event-time", default="start_time")
    load.add_argument("--cluster-by", default="user_id", help="columns, separated by commas")
    load.add_argument("--path", help="folder of the table; the warehouse's own if left out")
    load.add_argument("--partitions", type=int, help="tasks that sort and write")
    load.add_argument("--once", action="store_true", help="keep a ledger, and skip a day whose files have been loaded")
    recluster = job("recluster", "table", ds=False)
    recluster.add_argument("--event-time", default="start_time")
    recluster.add_argument("--cluster-by", default="user_id", help="columns, separated by commas")
    recluster.add_argument("--least-files", type=int, default=2, help="overlapping files to wait for")
    run = job("run", "lake", "schema", "database", "location")
    run.add_argument("--until", type=as_day, help="first day not to run: a backfill of the days before it")
    run.add_argument("--root", help="skip days without logs below this folder")
    run.add_argument("--whole-lake", action="store_true", help="read all folders, not only those of the days run")
    run.add_argument("--append", action="store_true", help="add to the daily table: a rerun doubles the day")
    run.add_argument("--keep-days", type=int, help="drop snapshots that are older than so many days")
    run.add_argument("--buckets", type=int, default=CalcTables.buckets)
    run.add_argument("--deltas", action="store_true", help="write the day's users and not all; of tables made so")
    run.add_argument("--compact-after", type=int, default=DeltaTables.compact_after, help="deltas that make a new base")
    correct = job("correct", "lake", "schema", "database", "location")
    correct.add_argument("--buckets", type=int, default=CalcTables.buckets)
    correct.add_argument("--whole-lake", action="store_true", help="read all folders, not only that of the day")
    job("strays", "root", ds=False)
    job("rebucket", "database", "location", "buckets", ds=False)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    args = parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"daytally {args.job} {args.ds or ''}".strip()).getOrCreate())
    return JOBS[args.job](spark, args)


def check(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.prefix:
        landed = prefix_gate(spark, args.prefix, args.suffix)
        return {"landed": landed, **size_profile(spark, args.prefix).first().asDict()}
    listing = log_objects(spark, args.root, [args.ds])
    return {"landed": landing_gate(spark, args.root, args.ds), **input_size_profile(listing).first().asDict()}


def ingest(spark: SparkSession, args: argparse.Namespace) -> dict:
    rule = SizeRule() if args.size_rule else None
    return ingest_day(spark, args.root, args.lake, args.ds, _parser(args), rule) or {}


def stream(spark: SparkSession, args: argparse.Namespace) -> dict:
    stream_ingest(
        spark, args.root, args.lake, args.checkpoint, _parser(args), max_file_age=args.max_file_age, glob=args.glob
    )
    return {"streamed": args.root}


def load(spark: SparkSession, args: argparse.Namespace) -> dict:
    schema, columns = T.StructType.fromDDL(args.schema), tuple(args.cluster_by.split(","))
    options = {"event_time": args.event_time, "cluster_by": columns, "path": args.path, "partitions": args.partitions}
    if args.all:
        load_lake(spark, args.lake, args.table, schema, **options)
        return {"loaded": "all"}
    loaded = load_day(spark, args.lake, args.table, args.ds, schema, **options, once=args.once)
    return {"loaded": str(args.ds) if loaded else "nothing"}


def recluster(spark: SparkSession, args: argparse.Namespace) -> dict:
    columns = tuple(args.cluster_by.split(","))
    return {"replaced": recluster_table(spark, args.table, args.event_time, columns, least_files=args.least_files)}


def strays(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Number and bytes, and the first of them by name."""
    found = stray_objects(spark, args.root)
    total = found.agg(F.count("path").alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    return {**total.asDict(), "first": [r["path"] for r in found.orderBy("path").limit(100).collect()]}


def events_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The events a run reads: those in the folders of its days, unless the whole lake is asked for."""
    schema = T.StructType.fromDDL(args.schema)
    if args.whole_lake:
        return read_events(spark, args.lake, schema)
    return read_events(spark, args.lake, schema, args.ds, getattr(args, "until", None))


def correct(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables = DeltaTables(spark, args.database, args.location, args.buckets).create()
    users = tables.correct_day(events_of(spark, args), args.ds)
    return {"users": users.count(), "changed": spark.table(tables.changed_temp).count()}


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables = CalcTables(spark, args.database, args.location, args.buckets)
    if args.deltas:
        tables = DeltaTables(spark, args.database, args.location, args.buckets, compact_after=args.compact_after)
    tables.create()
    events = events_of(spark, args)
    if args.until:
        users = backfill(tables, events, args.ds, args.until, args.root)
    else:
        users = run_day(tables, events, args.ds, args.root, replace=not args.append)
    if args.keep_days is not None:
        tables.drop_snapshots_before(args.ds - timedelta(days=args.keep_days))
    # Rows that the folders read have and that do not count on their day are reported, not lost unseen.
    return {"users": users.count() if users is not None else 0, **misplaced(events).first().asDict()}


def rebucket(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables = CalcTables(spark, args.database, args.location).create()
    tables.rebucket(int(args.buckets))
    return {"buckets": tables.stored_buckets()}


def _parser(args: argparse.Namespace) -> LineParser:
    return json_lines(T.StructType.fromDDL(args.schema), tuple(filter(None, args.required.split(","))))


JOBS = {
    "check": check,
    "ingest": ingest,
    "stream": stream,
    "load": load,
    "recluster": recluster,
    "run": run,
    "correct": correct,
    "strays": strays,
    "rebucket": rebucket,
}


if __name__ == "__main__":
    print(main())
