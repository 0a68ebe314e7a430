"""The stored tables of the daily job, and how a run writes to them."""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass, replace
from datetime import date, datetime
from itertools import accumulate
from threading import Event, Thread

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.dates import next_day
from daytally.functions.metrics import DEFAULT_METRICS, Metric, folds, states
from daytally.functions.rules import USER_ID_LENGTH, daily_rules
from daytally.operators.cumulative import cumulative_columns, merge_staging, upsert
from daytally.operators.quality import tag_rows
from daytally.operators.daily import daily_range
from daytally.operators.serial import POSITION, assign_ids, partition_sizes, with_positions
from daytally.sources.files import Files


class RunsOverlap(RuntimeError):
    """Another run has the lease of the tables."""


# Leases that this process holds, and whose they are.
_held: dict[str, str] = {}

LAYOUT = "USING parquet OPTIONS (partitionOverwriteMode 'dynamic')"


def recreate_staging(rows: DataFrame, table: str, path: str) -> DataFrame:
    """Drops the table if it exists and creates it from ``rows``, whatever an earlier run has left behind."""
    spark = rows.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
    return spark.table(table)


@dataclass(frozen=True)
class CalcTables:
    """The daily table, the cumulative table and their helpers, in one database.

    ``user_final_calc`` keeps one snapshot per run day, bucketed by user, so that an upsert need not move the old
    rows. Choose ``buckets`` so that a bucket of a snapshot is a few hundred MB; ``rebucket`` changes it later. Runs on the
    same tables must not overlap: they share the staging table and the id sequence.
    """

    spark: SparkSession
    database: str
    location: str
    buckets: int = 200
    metrics: tuple[Metric, ...] = DEFAULT_METRICS

    @property
    def final(self) -> str:
        return f"{self.database}.user_final_calc"

    @property
    def daily(self) -> str:
        return f"{self.database}.user_daily_calc"

    @property
    def id_sequence(self) -> str:
        return f"{self.database}.user_daily_calc_id_seq"

    @property
    def appended(self) -> str:
        return f"{self.database}.user_daily_calc_appended"

    @property
    def daily_temp(self) -> str:
        return f"{self.database}.user_daily_calc_temp"

    @contextmanager
    def lease(self, hours: float = 1) -> Iterator[None]:
        """Only one run at a time: another that begins meanwhile raises ``RunsOverlap`` before it writes anything.

        A file in the tables' folder, made by whoever comes first and renewed while the run goes on. One that a dead run
        has left counts until it expires. A run that finds its lease taken over, as it could not renew it in time, raises
        ``RunsOverlap`` before its next write. A lease within one of the same tables object is part of it.
        """
        name = self._lease_name
        if name in _held:
            yield
            return
        files, mine = Files(self.spark, self.location), uuid.uuid4().hex

        def text() -> str:
            until = time.time() + hours * 3600
            return json.dumps({"owner": mine, "until": until, "run": self.spark.sparkContext.applicationId})

        if not files.create(name, text()):
            held = self._lease_in(name) or {"until": time.time() + 1, "run": "one that has just begun or ended"}
            if held["until"] > time.time():
                raise RunsOverlap(f"{self.database} is in use by {held['run']}")
            # Of several that find it expired, one can move it away. What it has moved may be the lease of another that
            # did so before, though; that one gets it back.
            aside, taken = f"{name}-{mine}", RunsOverlap(f"{self.database} has just been taken by another run")
            try:
                files.rename(name, aside)
            except Py4JJavaError as gone:
                raise taken from gone
            moved = self._lease_in(aside)
            if moved != held:
                if moved:
                    files.rename(aside, name)
                raise taken
            files.delete(aside)
            if not files.create(name, text()):
                raise taken
        _held[name] = mine
        ended = Event()

        def renew() -> None:
            while not ended.wait(hours * 3600 / 4):
                with suppress(RunsOverlap, Py4JJavaError):
                    self._check_lease()
                    files.overwrite(name, text())

        renewal = Thread(target=renew, daemon=True)
        renewal.start()
        try:
            yield
        finally:
            ended.set()
            renewal.join()
            del _held[name]
            if (self._lease_in(name) or {}).get("owner") == mine:
                files.delete(name)

    @property
    def _lease_name(self) -> str:
        return f"{self.location}/_lease"

    def _lease_in(self, name: str) -> dict | None:
        try:
            return json.loads(Files(self.spark, self.location).read(name))
        except (Py4JJavaError, ValueError):
            return None

    def _check_lease(self) -> None:
        """Raises if another run has taken over the lease that this one holds."""
        mine = _held.get(self._lease_name)
        if mine and (self._lease_in(self._lease_name) or {}).get("owner") != mine:
            raise RunsOverlap(f"another run has taken over {self.database}")

    def create(self) -> CalcTables:
        """Creates what is missing. Overwrites replace only the partitions they write to.

        Tables that exist must have the columns that these metrics give, by name, order and type.
        """
        final, daily = self._final_columns(), self._daily_columns()
        for statement in (
            f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.location}'",
            self._create_final(self.final, self.buckets),
            f"""CREATE TABLE IF NOT EXISTS {self.daily} ({self._ddl(daily)})
                {LAYOUT} PARTITIONED BY (upload_date)""",
            f"CREATE TABLE IF NOT EXISTS {self.id_sequence} (max_id BIGINT, upload_date DATE) USING parquet",
            f"""CREATE TABLE IF NOT EXISTS {self.appended} (first_id BIGINT, upload_date DATE)
                {LAYOUT} PARTITIONED BY (upload_date)""",
        ):
            self.spark.sql(statement)
        for table, wanted in ((self.final, final), (self.daily, daily)):
            if "partitionOverwriteMode=dynamic" not in (self._described(table, "Storage Properties") or ""):
                raise ValueError(f"{table} lacks the option partitionOverwriteMode=dynamic: a run would wipe other days")
            stored = self._stored_columns(table)
            if stored != wanted:
                raise ValueError(f"{table} has other columns than these metrics give: {stored}, not {wanted}")
        return self

    def _final_columns(self) -> list[tuple[str, str]]:
        figures = [(s.name, s.sql_type) for s in states(self.metrics)]
        return [("user_id", f"varchar({USER_ID_LENGTH})"), *figures, ("update_time", "timestamp_ntz"), ("as_of", "date")]

    def _daily_columns(self) -> list[tuple[str, str]]:
        keys = [("id", "bigint"), ("user_id", f"varchar({USER_ID_LENGTH})"), ("event_date", "date")]
        figures = [(s.name, s.sql_type) for s in states(self.metrics)]
        return [*keys, *figures, ("update_time", "timestamp_ntz"), ("upload_date", "date")]

    @staticmethod
    def _ddl(columns: list[tuple[str, str]]) -> str:
        default = {"update_time": " DEFAULT LOCALTIMESTAMP()"}
        return ", ".join(f"{name} {kind}{default.get(name, '')}" for name, kind in columns)

    def _create_final(self, table: str, buckets: int) -> str:
        return f"""CREATE TABLE IF NOT EXISTS {table} ({self._ddl(self._final_columns())})
            {LAYOUT} PARTITIONED BY (as_of) CLUSTERED BY (user_id) INTO {buckets} BUCKETS"""

    def _stored_columns(self, table: str) -> list[tuple[str, str]]:
        described = [(r["col_name"], r["data_type"].lower()) for r in self.spark.sql(f"DESCRIBE {table}").collect()]
        end = next((i for i, (name, _) in enumerate(described) if not name or name.startswith("#")), len(described))
        return described[:end]

    def _insert(self, rows: DataFrame, table: str, overwrite: bool) -> None:
        """Inserts go by position; so the columns are brought into the table's own order first."""
        self._check_lease()
        rows.select(*self.spark.table(table).columns).write.insertInto(table, overwrite=overwrite)

    def _described(self, table: str, name: str) -> str | None:
        found = self.spark.sql(f"DESCRIBE FORMATTED {table}").where(F.col("col_name") == name).first()
        return found and found["data_type"]

    # Partitions

    def partition_days(self, table: str) -> list[date]:
        """The days a table has partitions for, from the catalog: names only, one per day run."""
        listed = self.spark.sql(f"SHOW PARTITIONS {table}").collect()
        return [date.fromisoformat(row["partition"].partition("=")[2]) for row in listed]

    def clear_day(self, table: str, column: str, day: date) -> None:
        """Empties one partition. A dynamic overwrite without rows for it would leave it as it is."""
        fields = [f for f in self.spark.table(table).schema if f.name != column]
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
        self.spark.sql(f"INSERT OVERWRITE {table} PARTITION ({column} = DATE '{day}') SELECT {nulls} WHERE false")

    # Daily table

    def stage_daily(self, daily: DataFrame) -> DataFrame:
        """Writes the day's rows once, in id order, each with the rule it breaks; rejects come last.

        Both result tables are filled from here, so that neither repeats the aggregate.
        """
        tagged = tag_rows(daily, daily_rules()).withColumn("rejected", F.col("broken_rule").isNotNull())
        placed = with_positions(tagged, "rejected", "upload_date", "user_id", "event_date")
        self._check_lease()
        return recreate_staging(placed, self.daily_temp, f"{self.location}/user_daily_calc_temp")

    def append_daily(self, staged: DataFrame, run_over: list[date], replace: bool = True) -> None:
        """Adds the staged good rows with new ids.

        ``replace`` swaps the upload days ``run_over``, so that a rerun gives the same table with the same ids; without
        it rows are added as they are, and a rerun doubles them. The ids are reserved, by a row per day in a table that
        only grows, before the rows are written: a run that dies between the two leaves a gap and no duplicate id.
        """
        good = staged.where(~F.col("rejected")).drop("rejected", "broken_rule")
        # One pass gives the rows per day and those per partition of the write. It has a row for each partition, and
        # one more for each day that begins inside one.
        counts = partition_sizes(good, "upload_date").collect()
        by_day, by_part = Counter(), Counter()
        for row in counts:
            by_day[row["upload_date"]] += row["n"]
            by_part[row["part"]] += row["n"]
        per_day = sorted(by_day.items())
        taken = self.spark.table(self.id_sequence)
        if replace:
            taken = taken.where(~F.col("upload_date").isin(run_over))
        start_after = taken.agg(F.max("max_id")).first()[0] or 0
        self._check_lease()
        self._note_mode(run_over, [day for day, _ in per_day], start_after, replace)
        if per_day:
            last_ids = list(accumulate((n for _, n in per_day), initial=start_after))[1:]
            values = ", ".join(f"({last}, DATE '{day}')" for last, (day, _) in zip(last_ids, per_day))
            self.spark.sql(f"INSERT INTO {self.id_sequence} VALUES {values}")
            sizes = self.spark.createDataFrame(sorted(by_part.items()), "part long, n long")
            self._insert(assign_ids(good, start_after, sizes=sizes), self.daily, replace)
        if replace:
            emptied = set(run_over).intersection(self.partition_days(self.daily))
            for day in emptied.difference(day for day, _ in per_day):
                self.clear_day(self.daily, "upload_date", day)

    def _note_mode(self, run_over: list[date], filled: list[date], start_after: int, replace: bool) -> None:
        """Keeps the days whose rows have been appended: such rows may count more than once, or on two days' runs."""
        if replace:
            for day in set(run_over).intersection(self.partition_days(self.appended)):
                self.spark.sql(f"ALTER TABLE {self.appended} DROP IF EXISTS PARTITION (upload_date = DATE '{day}')")
        else:
            for day in filled:
                self.spark.sql(f"INSERT OVERWRITE {self.appended} PARTITION (upload_date = DATE '{day}') SELECT {start_after}")

    def daily_rows(self, days: list[date]) -> DataFrame:
        """The daily rows of some days, to be added up in place of a snapshot. Appended days are refused: what a run has
        merged of them is in its snapshot only."""
        appended = sorted(set(days).intersection(self.partition_days(self.appended)))
        if appended:
            raise ValueError(f"no snapshot has the appended days {', '.join(map(str, appended))}; their rows cannot be added up")
        return self.spark.table(self.daily).where(F.col("upload_date").isin(days))

    def rejected(self) -> DataFrame:
        """Rows the last run kept out of both tables, with the rule each breaks."""
        staged = self.spark.table(self.daily_temp)
        return staged.where("rejected").drop("rejected", POSITION)

    # Cumulative table

    def stored_buckets(self) -> int:
        """The bucket count the cumulative table was created with, which counts if it differs from ``buckets``."""
        return int(self._described(self.final, "Num Buckets"))

    def drop_snapshots_before(self, day: date) -> None:
        """Drops old snapshots. A rerun of a day before the first one kept adds up all daily rows before it.

        Where days have been appended, their rows cannot be added up, so the last snapshot before ``day`` is kept.
        """
        kept = self.snapshot_before(day) if self.partition_days(self.appended) else None
        for run in self.partition_days(self.final):
            if run < day and run != kept:
                self._drop_snapshot(run)

    def _drop_snapshot(self, run: date) -> None:
        self.spark.sql(f"ALTER TABLE {self.final} DROP IF EXISTS PARTITION (as_of = DATE '{run}')")

    def rebucket(self, buckets: int) -> None:
        """Moves the latest snapshot to a table with another number of buckets, which takes the place of the old one.

        The old table, with the earlier snapshots, stays as ``user_final_calc_before``; drop it when it is not needed.
        """
        latest = max(self.partition_days(self.final), default=None)
        made, before = f"{self.final}_rebucketed", f"{self.final}_before"
        for table in (made, before):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(self._create_final(made, buckets))
        if latest is not None:
            moved = self.snapshot(latest).repartition(buckets, "user_id").withColumn("as_of", F.lit(latest))
            self._insert(moved, made, True)
        self.spark.sql(f"ALTER TABLE {self.final} RENAME TO {before}")
        self.spark.sql(f"ALTER TABLE {made} RENAME TO {self.final}")

    def add_metric(self, events: DataFrame, metric: Metric) -> CalcTables:
        """Tables with one metric more, filled from ``events`` for all days that have run; the last snapshot moves along.

        Both tables are written anew under other names, which then take the place of the old ones; those stay as
        ``..._before``. Daily rows keep their ids. The new states of a user are those of the user's daily rows, so days
        that have been appended are refused. ``self`` no longer fits the tables; go on with what comes back.
        """
        grown = replace(self, metrics=(*self.metrics, metric))
        with self.lease():
            run = sorted(self.partition_days(self.daily))
            latest = max(self.partition_days(self.final), default=None)
            daily = self.daily_rows(run)
            names = {table: f"{table}_grown" for table in (self.daily, self.final)}
            for table, made in names.items():
                self.spark.sql(f"DROP TABLE IF EXISTS {made}")
                self.spark.sql(f"DROP TABLE IF EXISTS {table}_before")
            self.spark.sql(f"CREATE TABLE {names[self.daily]} ({self._ddl(grown._daily_columns())}) {LAYOUT} PARTITIONED BY (upload_date)")
            self.spark.sql(grown._create_final(names[self.final], self.stored_buckets()))
            if run:
                keys = ["user_id", "event_date", "upload_date"]
                added = daily_range(events, run[0], next_day(run[-1]), (metric,), F.lit(None)).drop("update_time")
                added = added.where(F.col("upload_date").isin(run))
                self._insert(daily.join(added, keys, "left"), names[self.daily], True)
            if latest is not None:
                states = self.spark.table(names[self.daily]).where(F.col("upload_date") <= F.lit(latest))
                buckets = self.stored_buckets()
                per_user = states.groupBy("user_id").agg(*folds((metric,))).repartition(buckets, "user_id")
                moved = self.snapshot(latest).join(per_user, "user_id", "left").withColumn("as_of", F.lit(latest))
                self._insert(moved.repartition(buckets, "user_id"), names[self.final], True)
            for table, made in names.items():
                self.spark.sql(f"ALTER TABLE {table} RENAME TO {table}_before")
                self.spark.sql(f"ALTER TABLE {made} RENAME TO {table}")
        return grown.create()

    def snapshot_before(self, day: date) -> date | None:
        return max((run for run in self.partition_days(self.final) if run < day), default=None)

    def snapshot(self, as_of: date | None) -> DataFrame:
        rows = self.spark.table(self.final)
        wanted = F.lit(False) if as_of is None else F.col("as_of") == F.lit(as_of)
        return rows.where(wanted).select(*cumulative_columns(self.metrics))

    def latest(self) -> DataFrame:
        """The cumulative table as of its last run, one row per user."""
        return self.snapshot(max(self.partition_days(self.final), default=None))

    def upsert(self, staged: DataFrame, start: date, as_of: date, run_ts: datetime) -> DataFrame:
        """Merges the staged good rows into the users before ``start``, as the snapshot ``as_of``.

        The users before are the latest snapshot before ``start`` and the daily rows since, if days have run that have
        no snapshot. The snapshot read is never the one written, so a rerun starts from the same rows.

        Snapshots from ``start`` on are stale now and dropped, but for the one written. So ``latest`` is the run just
        done, and a later day that runs again starts from the corrected daily rows.
        """
        today = staged.where(~F.col("rejected"))
        buckets = self.stored_buckets()
        earlier = self.snapshot_before(start)
        known = self.snapshot(earlier)
        since = [d for d in self.partition_days(self.daily) if d < start and (earlier is None or d > earlier)]
        if since:
            known = merge_staging(known, self.daily_rows(since), self.metrics, buckets=buckets)
        for run in self.partition_days(self.final):
            if run >= start and run != as_of:
                self._drop_snapshot(run)
        merged = upsert(known, today, run_ts, self.metrics, buckets)
        self._insert(merged.withColumn("as_of", F.lit(as_of)), self.final, True)
        if earlier is None and not since and today.isEmpty():
            self.clear_day(self.final, "as_of", as_of)
        return self.snapshot(as_of)


