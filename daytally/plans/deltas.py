"""The cumulative table as a base and deltas, so that a run writes its day's users and not all that are known.

``user_final_calc`` holds base snapshots, ``user_final_calc_delta`` what each run adds, in the same buckets by user. A
ledger, ``user_final_calc_runs``, says which entries count: a run writes its rows first and its ledger row last, so a
run that dies in between leaves nothing that is read. It also has the run's time, which inactive users carry without
being written. Readers merge the last base and the entries since, bucket by bucket, without a shuffle; ``compact`` makes
that merge the next base.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions.dates import as_day, ntz, run_time
from daytally.functions.metrics import Metric, folds, state_names
from daytally.functions.rules import USER_ID_LENGTH
from daytally.operators.cumulative import KEY, cumulative_columns
from daytally.operators.daily import daily_calc
from daytally.plans.tables import LAYOUT, CalcTables, recreate_staging

RUN, CORRECTION, BASE, PENDING = "run", "correction", "base", "pending"


@dataclass(frozen=True, order=True)
class Entry:
    """A row of the ledger. Entries are in order of the day and of the number they got on it.

    run: the figures of the upload days ``first_day`` to ``as_of``, to be added. correction: whole users, in place of all
    that entries before say of them; ``first_day`` is the first day corrected. base: all entries up to here are in the
    snapshot of ``as_of``. pending: users that a correction has still to be made for; readers pass over it.
    """

    as_of: date
    seq: int
    kind: str
    first_day: date
    run_ts: datetime

    @property
    def at(self) -> tuple[date, int]:
        return self.as_of, self.seq


@dataclass(frozen=True)
class DeltaTables(CalcTables):
    """``CalcTables`` whose runs write deltas; after ``compact_after`` of them a run writes a base as well."""

    compact_after: int = 30

    @property
    def delta(self) -> str:
        return f"{self.database}.user_final_calc_delta"

    @property
    def runs(self) -> str:
        return f"{self.database}.user_final_calc_runs"

    @property
    def changed_temp(self) -> str:
        return f"{self.database}.user_changed_temp"

    def create(self) -> DeltaTables:
        super().create()
        kinds = [(n, k) for n, k in self._final_columns() if n != "as_of"]
        for statement in (
            f"""CREATE TABLE IF NOT EXISTS {self.delta} ({self._ddl(kinds)}, as_of DATE, seq INT)
                {LAYOUT} PARTITIONED BY (as_of, seq) CLUSTERED BY (user_id) INTO {self.stored_buckets()} BUCKETS""",
            f"""CREATE TABLE IF NOT EXISTS {self.runs} (kind STRING, first_day DATE, run_ts TIMESTAMP_NTZ, as_of DATE, seq INT)
                {LAYOUT} PARTITIONED BY (as_of, seq)""",
        ):
            self.spark.sql(statement)
        stored = self._stored_columns(self.delta)
        wanted = [*kinds, ("as_of", "date"), ("seq", "int")]
        if stored != wanted:
            raise ValueError(f"{self.delta} has other columns than these metrics give: {stored}, not {wanted}")
        return self

    # Ledger

    def entries(self) -> list[Entry]:
        """In order. A row per run, so few."""
        columns = ["as_of", "seq", "kind", "first_day", "run_ts"]
        return sorted(Entry(*row) for row in self.spark.table(self.runs).select(*columns).collect())

    def _record(self, entry: Entry) -> None:
        self.spark.sql(
            f"INSERT OVERWRITE {self.runs} PARTITION (as_of = DATE '{entry.as_of}', seq = {entry.seq}) "
            f"SELECT '{entry.kind}', DATE '{entry.first_day}', TIMESTAMP_NTZ '{entry.run_ts}'"
        )

    def _drop_entries(self, entries: list[Entry]) -> None:
        """The ledger first: rows without an entry are not read."""
        for table in (self.runs, self.delta):
            for e in entries:
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (as_of = DATE '{e.as_of}', seq = {e.seq})")

    @staticmethod
    def _live(entries: list[Entry]) -> tuple[Entry | None, list[Entry]]:
        """The last base, and the entries since that count."""
        base = max((e for e in entries if e.kind == BASE), default=None)
        return base, [e for e in entries if e.kind != PENDING and (base is None or e.at > base.at)]

    @staticmethod
    def _last_run(entries: list[Entry]) -> Entry | None:
        """The last run, or the base that it is in."""
        return max((e for e in entries if e.kind in (RUN, BASE)), default=None)

    @staticmethod
    def _partitions(entries: list[Entry]) -> Column:
        wanted = F.lit(False)
        for e in entries:
            wanted |= (F.col("as_of") == F.lit(e.as_of)) & (F.col("seq") == e.seq)
        return wanted

    def _next(self, as_of: date, entries: list[Entry]) -> int:
        return max((e.seq for e in entries if e.as_of == as_of), default=-1) + 1

    # Reads

    def snapshot(self, as_of: date | None) -> DataFrame:
        """All users as of the run of a day and its corrections, merged from the base and the entries up to then."""
        entries = [e for e in self.entries() if as_of is not None and e.as_of <= as_of]
        base, live = self._live(entries)
        columns = cumulative_columns(self.metrics)
        rows = self._base_rows(base)
        if not live:
            return rows.select(*columns)
        rows = self._stacked(rows, live)
        if any(e.kind == CORRECTION for e in live):
            # What a correction says of a user stands in place of all before it.
            whole = F.max(F.when(F.col("whole"), F.col("at"))).over(Window.partitionBy(KEY))
            rows = rows.withColumn("from", whole).where(F.col("from").isNull() | (F.col("at") >= F.col("from")))
        last = max((e for e in live if e.kind == RUN), default=None)
        merged = rows.groupBy(KEY).agg(
            *folds(self.metrics), F.max("update_time").alias("update_time"), F.min("at").alias("since")
        )
        stamp: Column = F.col("update_time")
        if last:
            stamp = F.when(F.col("since") < self._number(last), ntz(last.run_ts)).otherwise(stamp)
        # A user of whom a correction has left nothing has no time.
        return merged.where(F.col("update_time").isNotNull()).select(KEY, *state_names(self.metrics), stamp.alias("update_time"))

    def latest(self) -> DataFrame:
        return self.snapshot(max((e.as_of for e in self.entries()), default=None))

    def _base_rows(self, base: Entry | None) -> DataFrame:
        wanted = F.lit(False) if base is None else F.col("as_of") == F.lit(base.as_of)
        return self.spark.table(self.final).where(wanted)

    @staticmethod
    def _number(entry: Entry) -> int:
        return (entry.as_of - date(1970, 1, 1)).days * 1_000_000 + entry.seq

    def _stacked(self, base: DataFrame, live: list[Entry]) -> DataFrame:
        """Base and deltas with the number of their entry, both in their buckets: what groups by user needs no shuffle."""
        columns = [F.col(c).alias(c) for c in cumulative_columns(self.metrics)]
        old = base.select(*columns, F.lit(-1).cast("long").alias("at"), F.lit(False).alias("whole"))
        number = F.unix_date("as_of").cast("long") * 1_000_000 + F.col("seq")
        corrections = [self._number(e) for e in live if e.kind == CORRECTION]
        new = self.spark.table(self.delta).where(self._partitions(live)).select(
            *columns, number.alias("at"), (number.isin(corrections) if corrections else F.lit(False)).alias("whole")
        )
        return old.unionByName(new)

    # Writes

    def _add(self, rows: DataFrame, entry: Entry) -> None:
        """Writes an entry's rows in their buckets, then the entry."""
        placed = rows.repartition(self.stored_buckets(), KEY).select(
            *cumulative_columns(self.metrics), F.lit(entry.as_of).alias("as_of"), F.lit(entry.seq).alias("seq")
        )
        self._insert(placed, self.delta, True)
        self._record(entry)

    def _folded(self, daily: DataFrame) -> DataFrame:
        return daily.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
            *folds(self.metrics), F.max("update_time").alias("update_time")
        )

    def upsert(self, staged: DataFrame, start: date, as_of: date, run_ts: datetime) -> DataFrame:
        """Adds the staged good rows as the run's entry, whose size is that of the day, and returns all users.

        Entries and bases from ``start`` on are stale and dropped, as ``CalcTables`` drops snapshots. Days that have run
        since the last entry, but are in none, get one of their own first, from the daily table. Corrections of days before
        ``start`` are made again where they are dropped, and those that a dead run has left are made now.
        """
        entries = self.entries()
        stale = [e for e in entries if e.as_of >= start]
        entries = self._carry([e for e in entries if e.as_of < start], [e for e in stale if e.first_day < start])
        self._drop_entries(stale)
        for run in self.partition_days(self.final):
            if run >= start:
                self._drop_snapshot(run)
        base, live = self._live(entries)
        covered = lambda d: base is not None and d <= base.as_of or any(e.first_day <= d <= e.as_of for e in live)
        missing = [d for d in self.partition_days(self.daily) if d < start and not covered(d)]
        if missing:
            last = max(missing)
            found = Entry(last, self._next(last, entries), RUN, min(missing), run_time(last))
            self._add(self._folded(self.daily_rows(missing)), found)
        self._settle()
        self._add(self._folded(staged.where(~F.col("rejected"))), Entry(as_of, 0, RUN, start, run_ts))
        self._compact_if_long()
        return self.latest()

    def _compact_if_long(self) -> None:
        if len(self._live(self.entries())[1]) > self.compact_after:
            self.compact()

    def compact(self) -> None:
        """Writes the users as of the last entry as the base of the entries to come. Entries before stay, for reruns."""
        entries = self.entries()
        base, live = self._live(entries)
        if not live:
            return
        last, run = max(live), self._last_run(entries)
        merged = self.snapshot(last.as_of)
        if base is not None and base.as_of == last.as_of:
            # The partition that is read is also the one to be written.
            merged = recreate_staging(merged, f"{self.final}_temp", f"{self.location}/user_final_calc_temp")
            merged = merged.repartition(self.stored_buckets(), KEY)
        self._insert(merged.withColumn("as_of", F.lit(last.as_of)), self.final, True)
        self._record(Entry(last.as_of, self._next(last.as_of, entries), BASE, run.first_day, run.run_ts))

    def drop_snapshots_before(self, day: date) -> None:
        """Drops what no snapshot from ``day`` on needs: bases and entries before the last base that is not after it."""
        entries = self.entries()
        base, _ = self._live([e for e in entries if e.as_of <= day])
        if base is None:
            return
        self._drop_entries([e for e in entries if e.at < base.at and e.kind != PENDING])
        for run in self.partition_days(self.final):
            if run < base.as_of:
                self._drop_snapshot(run)

    def rebucket(self, buckets: int) -> None:
        raise NotImplementedError("base and deltas share their buckets; make new tables and backfill them")

    def add_metric(self, events: DataFrame, metric: Metric) -> DeltaTables:
        raise NotImplementedError("deltas hold the old states; make new tables and backfill them")

    # Corrections

    def correct_day(self, events: DataFrame, ds: str | date, partition_day: str | None = None) -> DataFrame:
        """Runs one earlier day again and mends the users whose rows it changes, without running the days after it.

        Of the daily table only rows of changed users are aggregated, and only these users are written, as an entry that
        stands in place of all before it. The result is that of running all days again. Returns all users.

        The changed users are noted before the daily table changes. So a correction that dies can be repeated, and the
        next run finishes it.
        """
        with self.lease():
            return self._correct(events, as_day(ds), partition_day)

    def _correct(self, events: DataFrame, day: date, partition_day: str | None) -> DataFrame:
        entries = self.entries()
        last = self._last_run(entries)
        if last is None or day > last.as_of:
            raise ValueError(f"{day} has not run yet")
        self.daily_rows([d for d in self._days_up_to(last) if d != day])
        staged = self.stage_daily(daily_calc(events, day, self.metrics, ntz(run_time(day)), partition_day=partition_day))
        self._add(self._blank(self._changed(staged, day)), Entry(last.as_of, self._next(last.as_of, entries), PENDING, day, last.run_ts))
        self.append_daily(staged, [day])
        self._settle()
        self._compact_if_long()
        return self.latest()

    def _days_up_to(self, last: Entry) -> list[date]:
        return [d for d in self.partition_days(self.daily) if d <= last.as_of]

    def _blank(self, users: DataFrame) -> DataFrame:
        """Users with no states, as rows of the delta table."""
        kinds = {f.name: f.dataType for f in self.spark.table(self.delta).schema}
        return users.select(KEY, *[F.lit(None).cast(kinds[c]).alias(c) for c in cumulative_columns(self.metrics) if c != KEY])

    def _users(self, entries: list[Entry]) -> DataFrame:
        return self.spark.table(self.delta).where(self._partitions(entries)).select(KEY).distinct()

    def _carry(self, kept: list[Entry], stale: list[Entry]) -> list[Entry]:
        """The kept entries, and one of the users that stale corrections are of: those have to be made again."""
        lost = [e for e in stale if e.kind in (CORRECTION, PENDING)]
        last = self._last_run(kept)
        if not lost or last is None:
            return kept
        carried = Entry(last.as_of, self._next(last.as_of, kept), PENDING, min(e.first_day for e in lost), last.run_ts)
        self._add(self._blank(self._users(lost)), carried)
        return [*kept, carried]

    def _settle(self) -> None:
        """Makes one correction of all that are pending, as of the last run."""
        entries = self.entries()
        pending = [e for e in entries if e.kind == PENDING]
        last = self._last_run(entries)
        if pending and last:
            path = f"{self.location}/user_changed_temp"
            changed = recreate_staging(self._users(pending), self.changed_temp, path)
            rows = self.daily_rows(self._days_up_to(last)).join(changed, KEY, "left_semi")
            # Whoever was there before the run's last day carries the run's time.
            known = F.min("upload_date") < F.lit(last.as_of)
            mended = rows.groupBy(KEY).agg(
                *folds(self.metrics), F.when(known, ntz(last.run_ts)).otherwise(F.max("update_time")).alias("update_time")
            )
            # Users without any row left have an entry too, an empty one.
            mended = changed.join(mended, KEY, "left")
            first = min(e.first_day for e in pending)
            self._add(mended, Entry(last.as_of, self._next(last.as_of, entries), CORRECTION, first, last.run_ts))
        self._drop_entries(pending)

    def _changed(self, staged: DataFrame, day: date) -> DataFrame:
        """Users that have another set of rows on the day than the daily table has."""
        columns = [KEY, "event_date", *state_names(self.metrics)]
        new = staged.where(~F.col("rejected")).select(*columns, F.lit(1).alias("side"))
        old = self.spark.table(self.daily).where(F.col("upload_date") == F.lit(day)).select(*columns, F.lit(-1).alias("side"))
        differs = new.unionByName(old).groupBy(*columns).agg(F.sum("side").alias("side")).where("side <> 0")
        return differs.select(F.col(KEY).cast(f"varchar({USER_ID_LENGTH})").alias(KEY)).distinct()

