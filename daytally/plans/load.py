"""Lake to warehouse table: append upload days, partitioned by event day and clustered."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.dates import as_day
from daytally.sources.lake import dataset, read_events
from daytally.sources.landing import list_objects, object_totals

BYTES_PER_PARTITION = 128 << 20
SAMPLED_PER_PARTITION = 100
# No event day is sampled by more keys than this, about. They and the day's bounds are one row each.
SAMPLED_PER_DAY = 100_000
# One job of a load makes no more partitions than this. Their bounds, a key each, go to every task.
PARTITIONS_PER_JOB = 10_000


def _place(key: Column, bounds: Column, partitions: int) -> Column:
    """How many of the sorted bounds are not above the key, by halving."""
    halvings = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(partitions)) + 1)))
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        up = (at["low"] < at["high"]) & (F.get(bounds, middle) <= key)
        down = (at["low"] < at["high"]) & ~(F.get(bounds, middle) <= key)
        return F.struct(
            F.when(up, middle + 1).otherwise(at["low"]).alias("low"), F.when(down, middle).otherwise(at["high"]).alias("high")
        )

    return F.aggregate(halvings, start, halve, lambda at: at["low"])


@dataclass(frozen=True)
class DayPlan:
    """Where the rows of an event day go: ``partitions`` of them from ``first`` on."""

    event_day: date | None
    rows: int
    first: int
    partitions: int

    @property
    def sampled(self) -> float:
        """The share of the rows whose keys are sampled; none if there is nothing to cut."""
        wanted = min(SAMPLED_PER_PARTITION * self.partitions, SAMPLED_PER_DAY)
        return min(1.0, wanted / self.rows) if self.partitions > 1 else 0.0


def plan_days(rows_per_day: list[tuple[date | None, int]], partitions: int) -> list[DayPlan]:
    """Days in order, large ones cut in proportion to their rows, small ones together in one partition."""
    each = max(1, math.ceil(sum(n for _, n in rows_per_day) / partitions))
    plans: list[DayPlan] = []
    place, filled = 0, 0
    for day, n in sorted(rows_per_day, key=lambda x: (x[0] is not None, x[0] or date.min)):
        if filled and filled + n > each:
            place, filled = place + 1, 0
        parts = max(1, round(n / each))
        plans.append(DayPlan(day, n, place, parts))
        place, filled = (place + parts, 0) if parts > 1 else (place, filled + n)
    return plans


def clustered(rows: DataFrame, event_time: str, cluster_by: tuple[str, ...], partitions: int) -> DataFrame:
    """Rows by event day, and within it ordered by the cluster columns across files and inside each.

    A cluster value may hold a third of the rows. Its rows are split further by event time and, where that is equal
    too, by their place in the source file, so that no single task gets them all.

    The bounds between partitions come from a sample of the key columns alone, so the other columns are read once;
    ``repartitionByRange`` would read all of them a first time for its own sample. Each event day is sampled and cut by
    itself, so what one row holds does not grow with the number of days.
    """
    spark = rows.sparkSession
    order = [*cluster_by, event_time, "source_row"]
    dated = rows.withColumn("event_day", F.to_date(event_time)).withColumn("source_row", F.col("_metadata.row_index"))
    if partitions > 1:
        # A row per day; of the files only the event times are read.
        found = dated.groupBy("event_day").agg(F.count(F.lit(1)).alias("n")).collect()
        plans = plan_days([(r["event_day"], r["n"]) for r in found], partitions)
        partitions = max((p.first + p.partitions for p in plans), default=1)
    if partitions > 1:
        planned = spark.createDataFrame(
            [(p.event_day, p.first, p.partitions, p.sampled) for p in plans],
            "planned_day date, first int, parts int, sampled double",
        )
        on_day = F.col("event_day").eqNullSafe(F.col("planned_day"))
        sampled = dated.join(F.broadcast(planned.where("parts > 1")), on_day).where(F.rand(7) < F.col("sampled"))
        keys = sampled.groupBy("planned_day", "parts").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("keys"))
        cut = lambda i: F.get("keys", F.floor(F.size("keys") * i / F.col("parts")).cast("int"))
        picked = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), cut)
        bounds = keys.select(F.col("planned_day").alias("bound_day"), F.array_distinct(F.array_compact(picked)).alias("bounds"))
        # A key per partition at most, and ``PARTITIONS_PER_JOB`` of them.
        where = planned.join(bounds, F.col("planned_day").eqNullSafe(F.col("bound_day")), "left").drop("bound_day")
        most = max(p.partitions for p in plans)
        within = F.when(F.col("bounds").isNull(), 0).otherwise(_place(F.struct(*order), F.col("bounds"), most))
        placed = dated.join(F.broadcast(where), on_day).withColumn("place", F.col("first") + within)
        dated = placed.repartitionById(partitions, "place").drop(*where.columns, "place")
    else:
        dated = dated.coalesce(1)
    return dated.sortWithinPartitions("event_day", *order).drop("source_row")


def partitions_for(spark: SparkSession, lake: str, ds: str | date | None = None) -> int:
    """One per ``BYTES_PER_PARTITION`` of the lake's files, of a day or of all days."""
    folder = f"{dataset(lake)}/upload_date={as_day(ds)}/" if ds else f"{dataset(lake)}/"
    return max(1, math.ceil(object_totals(spark, folder)[1] / BYTES_PER_PARTITION))


def load_day(
    spark: SparkSession,
    lake: str,
    table: str,
    ds: str | date,
    schema: T.StructType,
    event_time: str = "start_time",
    cluster_by: tuple[str, ...] = ("user_id",),
    path: str | None = None,
    partitions: int | None = None,
    once: bool = False,
) -> bool:
    """Appends one upload day of the lake to ``table``, created if absent. Loading a day twice doubles its rows.

    ``partitions`` is the number of tasks that sort and write, by default what the size of the day asks for. With
    ``once`` the table's ledger is kept and asked: a day whose same files have been loaded is skipped, and False comes
    back. A day that has been loaded from other files, or whose load did not end, raises ``DayLoaded``.
    """
    rows = read_events(spark, lake, schema, ds)
    ordered = clustered(rows, event_time, cluster_by, partitions or partitions_for(spark, lake, ds))
    if not once:
        append(ordered, table, path)
        return True
    ledger = LoadLedger(spark, table, path).create()
    load = ledger.of_day(lake, ds)
    if ledger.has(load):
        return False
    ledger.note(load, BEGUN)
    append(ordered, table, path)
    ledger.note(load, DONE)
    return True


BEGUN, DONE = "begun", "done"


class DayLoaded(ValueError):
    """Loading the day would double rows, or might."""


@dataclass(frozen=True)
class Load:
    """An upload day's files as a load takes them; ``digest`` is that of their names and lengths."""

    day: date
    files: int
    bytes: int
    digest: str


@dataclass(frozen=True)
class LoadLedger:
    """A row when a load begins and one when it has ended, beside the table it loads."""

    spark: SparkSession
    table: str
    path: str | None = None

    @property
    def name(self) -> str:
        return f"{self.table}_loads"

    def create(self) -> LoadLedger:
        place = f" LOCATION '{self.path}_loads'" if self.path else ""
        self.spark.sql(
            f"""CREATE TABLE IF NOT EXISTS {self.name}
            (day DATE, files BIGINT, bytes BIGINT, digest STRING, state STRING, at TIMESTAMP) USING parquet{place}"""
        )
        return self

    def of_day(self, lake: str, ds: str | date) -> Load:
        day = as_day(ds)
        objects = list_objects(self.spark, f"{dataset(lake)}/upload_date={day}/", ".parquet")
        name = F.concat_ws(" ", F.regexp_extract("path", "([^/]+)$", 1), F.col("length").cast("string"))
        # A sum of hashes does not depend on the order, and nothing has to be in one place.
        totals = objects.select("length", F.xxhash64(name).cast("decimal(38,0)").alias("hash")).agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.sum("hash").alias("hash")
        )
        found = totals.first()
        return Load(day, found["files"], found["bytes"], str(found["hash"]))

    def has(self, load: Load) -> bool:
        """Whether the same files have been loaded. Other loads of the day are errors."""
        rows = self.spark.table(self.name).where(F.col("day") == F.lit(load.day)).collect()
        done = {r["digest"] for r in rows if r["state"] == DONE}
        begun = {r["digest"] for r in rows if r["state"] == BEGUN}
        if begun - done:
            raise DayLoaded(f"a load of {load.day} into {self.table} did not end: look for its rows, then settle the ledger")
        if done - {load.digest}:
            raise DayLoaded(f"{load.day} has been loaded into {self.table} from other files")
        return bool(done)

    def note(self, load: Load, state: str) -> None:
        values = f"DATE '{load.day}', {load.files}, {load.bytes}, '{load.digest}', '{state}', current_timestamp()"
        self.spark.sql(f"INSERT INTO {self.name} SELECT {values}")

    def settle(self, ds: str | date, loaded: bool) -> None:
        """Says of a load that did not end whether its rows are in the table."""
        rows = self.spark.table(self.name).where(F.col("day") == F.lit(as_day(ds)))
        kept = [r for r in self.spark.table(self.name).collect() if r["day"] != as_day(ds) or r["state"] == DONE]
        open_ = [r for r in rows.collect() if r["state"] == BEGUN]
        schema = self.spark.table(self.name).schema
        added = [(*r[:4], state, r["at"]) for r in open_ for state in (BEGUN, DONE)] if loaded else []
        whole = self.spark.createDataFrame([*map(tuple, kept), *added], schema)
        whole.write.insertInto(self.name, overwrite=True)


def load_lake(
    spark: SparkSession,
    lake: str,
    table: str,
    schema: T.StructType,
    event_time: str = "start_time",
    cluster_by: tuple[str, ...] = ("user_id",),
    path: str | None = None,
    partitions: int | None = None,
) -> None:
    """Appends all days of the lake, for a first load: in one job, or in some if there is more than one can place.

    ``partitions`` is the number of them for the whole lake, by default by its size. Each job takes upload days that follow
    one another. A job that fails leaves those before it; the days it was to load are in the error's notes.
    """
    sizes = day_sizes(spark, lake)
    total = sum(sizes.values())
    wanted = partitions or max(1, math.ceil(total / BYTES_PER_PARTITION))
    for days in job_days(sizes, wanted):
        share = max(1, math.ceil(wanted * sum(sizes[d] for d in days) / max(1, total)))
        rows = read_events(spark, lake, schema).where(F.col("upload_date").isin(days))
        try:
            append(clustered(rows, event_time, cluster_by, share), table, path)
        except Exception as error:
            error.add_note(f"not loaded: upload days from {days[0]} on")
            raise


def day_sizes(spark: SparkSession, lake: str) -> dict[date, int]:
    """Bytes of the lake's files by upload day."""
    objects = list_objects(spark, f"{dataset(lake)}/", ".parquet")
    day = F.regexp_extract("path", "/upload_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1)
    sized = objects.groupBy(day.alias("day")).agg(F.sum("length").alias("bytes")).where("day <> ''")
    return {as_day(r["day"]): r["bytes"] for r in sized.collect()}


def job_days(sizes: dict[date, int], partitions: int) -> list[list[date]]:
    """The days of each job, in order: as many as make ``PARTITIONS_PER_JOB`` partitions, or one that makes more."""
    room = max(1, sum(sizes.values())) * PARTITIONS_PER_JOB / partitions
    jobs: list[list[date]] = []
    filled = 0.0
    for day in sorted(sizes):
        if not jobs or filled + sizes[day] > room:
            jobs.append([])
            filled = 0.0
        jobs[-1].append(day)
        filled += sizes[day]
    return jobs


def append(rows: DataFrame, table: str, path: str | None) -> None:
    writer = rows.write.mode("append").partitionBy("event_day").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
