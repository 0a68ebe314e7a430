"""The registered queries: each takes a session and a table folder, and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.dates import days, next_day, ntz, run_time, run_time_of
from daytally.functions.loglines import json_lines
from daytally.functions.metrics import (
    DEFAULT_METRICS,
    RICH_METRICS,
    Average,
    Different,
    EventCount,
    Metric,
    Quantile,
    figures,
    per_day,
)
from daytally.functions.rules import user_rules
from daytally.operators.cumulative import (
    insert_new_users,
    left_join_keys,
    merge_staging,
    update_from,
    upsert,
)
from daytally.operators.daily import daily_calc, daily_range
from daytally.operators.quality import constraint_violations, duplicate_keys, split_rows
from daytally.plans.deltas import DeltaTables
from daytally.plans.ingest import ingest_day, ingest_logs
from daytally.plans.load import append, clustered, load_day, load_lake
from daytally.plans.pipeline import backfill, run_day, run_days
from daytally.plans.recluster import file_ranges, overlaps, recluster
from daytally.plans.tables import CalcTables, recreate_staging
from daytally.session import configure, run_dir
from daytally.sources.lake import read_events, read_rejects
from daytally.sources.landing import (
    SizeRule,
    landing_inventory,
    landing_status,
    size_profile,
)
from daytally.sources.manifest import Manifest
from daytally.streaming.batches import read_batches, stream_batches
from daytally.streaming.ingest import stream_ingest
from daytally.workload.views import UPLOAD_SCHEMA, log_lines, log_tree, uploads, write_log_tree

Query = Callable[[SparkSession, str], DataFrame]

# Upload days of the data, and the days the one-day queries look at.
FIRST_DAY, END = date(2024, 1, 1), date(2024, 2, 2)
SECOND_DAY = date(2024, 1, 2)
FIFTH_DAY = date(2024, 1, 5)
LATE_DAY = date(2024, 1, 29)

PARSER = json_lines(UPLOAD_SCHEMA, required=("upload_time",))

# So that some days of the smaller tables are above it and some are not.
SMALL_RULE = SizeRule(threshold=100_000)


def for_output(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, after all sums are done."""
    casts = {f.name: F.col(f.name).cast("double") for f in rows.schema if isinstance(f.dataType, T.DecimalType)}
    return rows.withColumns(casts) if casts else rows


def new_tables(spark: SparkSession, label: str, kind: type[CalcTables] = CalcTables, **options) -> CalcTables:
    configure(spark)
    database = f"daytally_{label}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return kind(spark, database, run_dir(spark, label), buckets, **options).create()


# Daily table


def daily_of(spark: SparkSession, sf_dir: str, ds: date, dirty: bool = False, **options) -> DataFrame:
    return daily_calc(uploads(spark, sf_dir, ds, next_day(ds), dirty), ds, **options)


def q_daily_calc(spark: SparkSession, sf_dir: str, inclusive_end: bool = False) -> DataFrame:
    return for_output(daily_of(spark, sf_dir, FIFTH_DAY, inclusive_end=inclusive_end))


def q_recreate_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = new_tables(spark, "staging")
    folder = f"{tables.location}/staging"
    # A first version, of another day, that the second one must replace.
    recreate_staging(daily_of(spark, sf_dir, FIFTH_DAY), tables.daily_temp, folder)
    return for_output(recreate_staging(daily_of(spark, sf_dir, SECOND_DAY), tables.daily_temp, folder))


def q_daily_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = new_tables(spark, "append")
    staged = tables.stage_daily(daily_of(spark, sf_dir, FIFTH_DAY))
    tables.append_daily(staged, [FIFTH_DAY])
    return for_output(spark.table(tables.daily))


def q_backfill_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = new_tables(spark, "backfill")
    backfill(tables, uploads(spark, sf_dir, dirty=True), FIRST_DAY, END)
    return for_output(spark.table(tables.daily))


def q_daily_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages, numbers of different event types and medians of all days."""
    configure(spark)
    stamp = run_time_of(F.col("upload_date"))
    daily = daily_range(uploads(spark, sf_dir), FIRST_DAY, END, RICH_METRICS, stamp)
    return for_output(figures(daily, RICH_METRICS))


# Cumulative table


def previous_of(spark: SparkSession, sf_dir: str, ds: date, dirty: bool = False) -> DataFrame:
    """The cumulative table before ``ds``: all earlier uploads, last run the day before."""
    rows = uploads(spark, sf_dir, end=ds, dirty=dirty).where(F.col("upload_time") < ntz(ds))
    good, _ = split_rows(rows, user_rules())
    stamp = ntz(run_time(days(FIRST_DAY, ds)[-1]))
    return good.groupBy("user_id").agg(*per_day(DEFAULT_METRICS)).withColumn("update_time", stamp)


def good_daily(spark: SparkSession, sf_dir: str, ds: date, dirty: bool = False) -> DataFrame:
    good, _ = split_rows(daily_of(spark, sf_dir, ds, dirty), user_rules())
    return good


def partitions_of(previous: DataFrame) -> int:
    """``previous_of`` ends in an aggregate by user, which leaves this many partitions by user."""
    return int(previous.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def q_merge(
    spark: SparkSession, sf_dir: str, ds: date, distinct: bool = False, metrics: tuple[Metric, ...] = DEFAULT_METRICS
) -> DataFrame:
    previous, daily = previous_of(spark, sf_dir, ds), good_daily(spark, sf_dir, ds)
    return for_output(merge_staging(previous, daily, metrics, distinct, partitions_of(previous)))


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows as a table of their own: what a plan uses twice is computed once."""
    path = run_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


# The date of ``upload_time``, by which the feed's files are laid out.
BY_DAY = "upload_day"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All uploads as a table of their own, by upload day: a day's run reads its day's files, not those of all days."""
    path = run_dir(spark, "uploads")
    rows = uploads(spark, sf_dir).withColumn(BY_DAY, F.to_date("upload_time"))
    rows.write.partitionBy(BY_DAY).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def q_update_from(spark: SparkSession, sf_dir: str, ds: date) -> DataFrame:
    previous, daily = stored(previous_of(spark, sf_dir, ds), "previous"), good_daily(spark, sf_dir, ds)
    return for_output(update_from(previous, merge_staging(previous, daily), run_time(ds)))


def q_insert_new_users(spark: SparkSession, sf_dir: str, ds: date, dirty: bool = False) -> DataFrame:
    previous, daily = stored(previous_of(spark, sf_dir, ds, dirty), "previous"), good_daily(spark, sf_dir, ds, dirty)
    return for_output(insert_new_users(previous, merge_staging(previous, daily)))


def q_left_join_keys(spark: SparkSession, sf_dir: str, ds: date) -> DataFrame:
    return left_join_keys(previous_of(spark, sf_dir, ds), good_daily(spark, sf_dir, ds))


def q_upsert_final(spark: SparkSession, sf_dir: str, ds: date, dirty: bool = False) -> DataFrame:
    previous, daily = previous_of(spark, sf_dir, ds, dirty), good_daily(spark, sf_dir, ds, dirty)
    return for_output(upsert(previous, daily, run_time(ds), buckets=partitions_of(previous)))


def q_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days before the late one as a stored snapshot, then the late day on top of it."""
    tables = new_tables(spark, "upsert")
    previous_day = days(FIRST_DAY, LATE_DAY)[-1]
    backfill(tables, uploads(spark, sf_dir, end=LATE_DAY, dirty=True), FIRST_DAY, LATE_DAY)
    assert tables.snapshot_before(LATE_DAY) == previous_day
    events = uploads(spark, sf_dir, LATE_DAY, next_day(LATE_DAY), dirty=True)
    return for_output(run_day(tables, events, LATE_DAY))


def q_upsert_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures per user: a backfill, then four days one by one, so that states are folded over and over."""
    tables, events = new_tables(spark, "figures", metrics=RICH_METRICS), feed(spark, sf_dir)
    backfill(tables, events, FIRST_DAY, LATE_DAY)
    run_days(tables, events, LATE_DAY, END, partition_day=BY_DAY)
    return for_output(figures(tables.latest(), RICH_METRICS))


def q_add_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that have run without them get an average and a median; then the last days run."""
    tables, events = new_tables(spark, "grown"), feed(spark, sf_dir)
    backfill(tables, events, FIRST_DAY, LATE_DAY)
    for metric in (Average(), Different(), Quantile()):
        tables = tables.add_metric(events, metric)
    run_days(tables, events, LATE_DAY, END, partition_day=BY_DAY)
    return for_output(figures(tables.latest(), tables.metrics))


def q_run_days(spark: SparkSession, sf_dir: str, end: date = END) -> DataFrame:
    """Day by day over all upload days; the last snapshot."""
    tables = new_tables(spark, "run")
    return for_output(run_days(tables, feed(spark, sf_dir), FIRST_DAY, end, partition_day=BY_DAY))


def q_run_days_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day by day as deltas, with a base now and then; all users as of the last run."""
    tables = new_tables(spark, "deltas", DeltaTables, compact_after=12)
    return for_output(run_days(tables, feed(spark, sf_dir), FIRST_DAY, END, partition_day=BY_DAY))


def q_correct_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days run while the second lacks some uploads and has others twice; then that day alone is corrected."""
    tables, events = new_tables(spark, "correct", DeltaTables), feed(spark, sf_dir)
    second = F.to_date("upload_time") == F.lit(SECOND_DAY)
    wrong = events.where(~(second & (F.col("event_id") % 3 == 0))).unionByName(events.where(second & (F.col("event_id") % 7 == 0)))
    backfill(tables, wrong, FIRST_DAY, LATE_DAY)
    run_days(tables, wrong, LATE_DAY, END, partition_day=BY_DAY)
    return for_output(tables.correct_day(events, SECOND_DAY, partition_day=BY_DAY))


def q_run_days_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a range that is wider than what has landed, each day from its own folder of the lake."""
    tables, lake = new_tables(spark, "gated"), shared_lake(spark, sf_dir)
    root, rows = log_tree(spark, sf_dir), None
    for ds in days(date(2023, 12, 30), date(2024, 2, 4)):
        done = run_day(tables, read_events(spark, lake, UPLOAD_SCHEMA, ds), ds, landing_root=root)
        rows = rows if done is None else done
    return for_output(rows)


def inclusive_tables(spark: SparkSession, sf_dir: str) -> CalcTables:
    """Appending runs over all days that also take the next midnight, as BETWEEN does. Each query does its own runs."""
    tables, events = new_tables(spark, "inclusive"), feed(spark, sf_dir)
    for ds in days(FIRST_DAY, END):
        run_day(tables, events, ds, replace=False, inclusive_end=True, partition_day=BY_DAY)
    return tables


def q_run_days_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cumulative table of such runs, old snapshots dropped: midnight rows count in both runs that take them."""
    tables = inclusive_tables(spark, sf_dir)
    tables.drop_snapshots_before(END)
    return for_output(tables.latest())


def q_run_days_inclusive_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table of such runs."""
    return for_output(spark.table(inclusive_tables(spark, sf_dir).daily).drop("id"))


def q_rerun_after_backfill(spark: SparkSession, sf_dir: str, kind: type[CalcTables] = CalcTables) -> DataFrame:
    """All days run while the second lacks some uploads; a backfill corrects all but the last; the last runs again."""
    tables, events = new_tables(spark, "rerun", kind), feed(spark, sf_dir)
    last = days(FIRST_DAY, END)[-1]
    late = (F.to_date("upload_time") == F.lit(SECOND_DAY)) & (F.col("event_id") % 3 == 0)
    run_days(tables, events.where(~late), FIRST_DAY, END, partition_day=BY_DAY)
    backfill(tables, events, FIRST_DAY, last)
    run_day(tables, events, last, partition_day=BY_DAY)
    return for_output(tables.latest())


def q_backfill_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = new_tables(spark, "closed")
    return for_output(backfill(tables, uploads(spark, sf_dir), FIRST_DAY, END))


# Rules


def q_constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraint_violations(uploads(spark, sf_dir, dirty=True), user_rules())


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(uploads(spark, sf_dir), "user_id")


# Files


def new_lake(spark: SparkSession, sf_dir: str, garbage: bool = False) -> str:
    configure(spark)
    lake = run_dir(spark, "lake")
    ingest_logs(spark, log_tree(spark, sf_dir, garbage), lake, PARSER)
    return lake


_lakes: dict[tuple[str, str], str] = {}


def shared_lake(spark: SparkSession, sf_dir: str) -> str:
    """A clean lake for the queries that read one; ingest itself is measured by ``ingest_logs``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        _lakes[key] = new_lake(spark, sf_dir)
    return _lakes[key]


def q_ingest_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, new_lake(spark, sf_dir), UPLOAD_SCHEMA)


def q_ingest_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, new_lake(spark, sf_dir, garbage=True), UPLOAD_SCHEMA)


def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rejects(spark, new_lake(spark, sf_dir, garbage=True))


def ingested_by_day(spark: SparkSession, sf_dir: str, rule: SizeRule | None = None) -> tuple[str, str]:
    """A lake filled day by day, one day done again, from a tree that also has folders which are no dates."""
    configure(spark)
    root, lake = run_dir(spark, "landing"), run_dir(spark, "lake")
    lines = log_lines(spark, sf_dir)
    stray = lines.where("folder = '20240105'").withColumn("folder", F.explode(F.array(F.lit("20240105x"), F.lit("20241399"))))
    write_log_tree(lines.unionByName(stray), root)
    for ds in [*days(FIRST_DAY, END), FIFTH_DAY]:
        ingest_day(spark, root, lake, ds, PARSER, rule)
    return root, lake


def q_ingest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lake = ingested_by_day(spark, sf_dir)
    return read_events(spark, lake, UPLOAD_SCHEMA)


def q_ingest_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each day, the number the rule picks, and whether no more files than that were written."""
    root, lake = ingested_by_day(spark, sf_dir, SMALL_RULE)
    written = read_events(spark, lake, UPLOAD_SCHEMA).select("upload_date", F.input_file_name().alias("file"))
    files = written.groupBy("upload_date").agg(F.countDistinct("file").alias("n_files"))
    sizes = landing_inventory(spark, root).withColumn("writers", SMALL_RULE.column(F.col("total_bytes")))
    return sizes.join(files, F.col("log_date") == F.col("upload_date")).select(
        "log_date", "total_bytes", "writers", (F.col("n_files") <= F.col("writers")).alias("within")
    )


def q_lake_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, shared_lake(spark, sf_dir), UPLOAD_SCHEMA, SECOND_DAY)


def q_daily_calc_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, shared_lake(spark, sf_dir), UPLOAD_SCHEMA)
    return for_output(daily_calc(events, FIFTH_DAY, partition_day="upload_date"))


def q_logs_to_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: logs that have landed, the lake, the daily table, the cumulative table."""
    tables = new_tables(spark, "logs")
    lake = new_lake(spark, sf_dir, garbage=True)
    events = read_events(spark, lake, UPLOAD_SCHEMA)
    root = log_tree(spark, sf_dir, garbage=True)
    return for_output(backfill(tables, events, FIRST_DAY, END, root, partition_day="upload_date"))


def q_warehouse(spark: SparkSession, sf_dir: str, loads: list[date], once: bool = False) -> DataFrame:
    configure(spark)
    lake = shared_lake(spark, sf_dir)
    path, table = run_dir(spark, "warehouse"), f"daytally_warehouse_{uuid.uuid4().hex[:12]}"
    for ds in loads:
        load_day(spark, lake, table, ds, UPLOAD_SCHEMA, path=path, once=once)
    return spark.table(table)


def q_warehouse_load_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    lake = shared_lake(spark, sf_dir)
    table = f"daytally_warehouse_{uuid.uuid4().hex[:12]}"
    load_lake(spark, lake, table, UPLOAD_SCHEMA, path=run_dir(spark, "warehouse"))
    return spark.table(table)


_reclustered: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def reclustered(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All upload days in three loads, every third day each, clustered anew; the overlap of the files before that."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _reclustered:
        return _reclustered[key]
    events = read_events(spark, shared_lake(spark, sf_dir), UPLOAD_SCHEMA)
    path, table = run_dir(spark, "warehouse"), f"daytally_warehouse_{uuid.uuid4().hex[:12]}"
    for turn in range(3):
        part = events.where(F.unix_date("upload_date") % 3 == turn)
        append(clustered(part, "start_time", ("user_id",), 2), table, path)
    before = stored(overlaps(file_ranges(spark, table, ("user_id", "start_time"))), "overlaps")
    recluster(spark, table)
    _reclustered[key] = table, before
    return table, before


def q_warehouse_reclustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(reclustered(spark, sf_dir)[0])


def q_recluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event day: whether several files had the same keys before, and how many do after."""
    table, before = reclustered(spark, sf_dir)
    after = overlaps(file_ranges(spark, table, ("user_id", "start_time")))
    shown = before.select("event_day", (F.col("depth") > 1).alias("overlapped"))
    return after.join(shown, "event_day").select("event_day", "overlapped", "n_overlapping", "depth")


def q_landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_inventory(spark, log_tree(spark, sf_dir)).select("log_date", "total_bytes")


def q_landing_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_status(spark, log_tree(spark, sf_dir), date(2023, 12, 30), date(2024, 2, 5))


def q_input_size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return size_profile(spark, f"{log_tree(spark, sf_dir)}/").select("total_bytes", "writers")


def listed(spark: SparkSession, sf_dir: str) -> Manifest:
    """Filled by a whole listing, then brought up to date by one of the last month."""
    configure(spark)
    manifest = Manifest(spark, run_dir(spark, "manifest"), log_tree(spark, sf_dir))
    manifest.update()
    manifest.update(since=END)
    return manifest


def q_manifest_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(spark, sf_dir).inventory().select("log_date", "total_bytes")


def q_manifest_size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(spark, sf_dir).size_profile()


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files: the second one finds nothing new."""
    configure(spark)
    root, lake, checkpoint = log_tree(spark, sf_dir), run_dir(spark, "stream"), run_dir(spark, "stream-checkpoint")
    for _ in range(2):
        stream_ingest(spark, root, lake, checkpoint, PARSER)
    return spark.read.parquet(lake).where(F.col("kind") == "good").drop("kind", "line")


def q_stream_ingest_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run finds logs that came late, as copies with modification times of long ago."""
    configure(spark)
    root, lake, checkpoint = run_dir(spark, "landing"), run_dir(spark, "stream"), run_dir(spark, "stream-checkpoint")
    lines = log_lines(spark, sf_dir)
    early = F.col("folder") % 2 == 0
    write_log_tree(lines.where(early), root)
    stream_ingest(spark, root, lake, checkpoint, PARSER)
    write_log_tree(lines.where(~early), root, age=timedelta(days=30))
    stream_ingest(spark, root, lake, checkpoint, PARSER)
    return spark.read.parquet(lake).where(F.col("kind") == "good").drop("kind", "line")


def q_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even days' logs first, then the rest, in batches of a few files; read without a sink log."""
    configure(spark)
    root, lake, checkpoint = run_dir(spark, "landing"), run_dir(spark, "stream"), run_dir(spark, "stream-checkpoint")
    lines = log_lines(spark, sf_dir)
    even = F.col("folder") % 2 == 0
    for part in (even, ~even):
        write_log_tree(lines.where(part), root)
        stream_batches(spark, root, lake, checkpoint, PARSER, max_files_per_batch=40)
    return read_batches(spark, lake, UPLOAD_SCHEMA).drop("line", "source_file")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over the first three days; the last snapshot."""
    return q_run_days(spark, sf_dir, date(2024, 1, 4))


QUERIES: dict[str, Query] = {
    "daily_calc": q_daily_calc,
    "daily_calc_inclusive": partial(q_daily_calc, inclusive_end=True),
    "daily_figures": q_daily_figures,
    "recreate_staging": q_recreate_staging,
    "daily_append": q_daily_append,
    "backfill_daily": q_backfill_daily,
    "union_distinct_final": partial(q_merge, ds=SECOND_DAY, distinct=True, metrics=(EventCount(),)),
    "union_distinct_final_late": partial(q_merge, ds=LATE_DAY, distinct=True, metrics=(EventCount(),)),
    "union_all_final": partial(q_merge, ds=SECOND_DAY),
    "union_all_final_late": partial(q_merge, ds=LATE_DAY),
    "update_from": partial(q_update_from, ds=SECOND_DAY),
    "update_from_late": partial(q_update_from, ds=LATE_DAY),
    "insert_new_users": partial(q_insert_new_users, ds=SECOND_DAY),
    "insert_new_users_dirty": partial(q_insert_new_users, ds=SECOND_DAY, dirty=True),
    "left_join_keys": partial(q_left_join_keys, ds=SECOND_DAY),
    "left_join_keys_late": partial(q_left_join_keys, ds=LATE_DAY),
    "upsert_final": partial(q_upsert_final, ds=SECOND_DAY),
    "upsert_final_dirty": partial(q_upsert_final, ds=SECOND_DAY, dirty=True),
    "upsert_final_late": partial(q_upsert_final, ds=LATE_DAY),
    "upsert_bucketed": q_upsert_bucketed,
    "upsert_figures": q_upsert_figures,
    "add_metric": q_add_metric,
    "run_days": q_run_days,
    "run_days_deltas": q_run_days_deltas,
    "correct_day": q_correct_day,
    "run_days_gated": q_run_days_gated,
    "run_days_inclusive": q_run_days_inclusive,
    "run_days_inclusive_all": q_run_days_inclusive_all,
    "rerun_after_backfill": partial(q_rerun_after_backfill, kind=DeltaTables),
    "rerun_after_backfill_all": q_rerun_after_backfill,
    "backfill_closed_form": q_backfill_closed_form,
    "constraint_violations": q_constraint_violations,
    "duplicate_keys": q_duplicate_keys,
    "ingest_logs": q_ingest_logs,
    "ingest_good": q_ingest_good,
    "ingest_rejects": q_ingest_rejects,
    "ingest_days": q_ingest_days,
    "ingest_sized": q_ingest_sized,
    "lake_partition_read": q_lake_partition_read,
    "daily_calc_lake": q_daily_calc_lake,
    "logs_to_final": q_logs_to_final,
    "warehouse_append": partial(q_warehouse, loads=[SECOND_DAY]),
    "warehouse_append_twice": partial(q_warehouse, loads=[SECOND_DAY, SECOND_DAY]),
    "warehouse_append_once": partial(q_warehouse, loads=[SECOND_DAY, SECOND_DAY], once=True),
    "warehouse_load_lake": q_warehouse_load_lake,
    "warehouse_reclustered": q_warehouse_reclustered,
    "recluster_report": q_recluster_report,
    "landing_inventory": q_landing_inventory,
    "landing_gate": q_landing_gate,
    "input_size_profile": q_input_size_profile,
    "manifest_inventory": q_manifest_inventory,
    "manifest_size_profile": q_manifest_size_profile,
    "stream_ingest": q_stream_ingest,
    "stream_ingest_late": q_stream_ingest_late,
    "stream_batches": q_stream_batches,
}
