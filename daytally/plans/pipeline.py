"""The daily run, and runs over many days."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.functions.dates import as_day, days, ntz, run_time, run_time_of
from daytally.operators.daily import daily_calc, daily_range
from daytally.plans.tables import CalcTables
from daytally.sources.landing import landing_gate, landing_inventory


def run_day(
    tables: CalcTables,
    events: DataFrame,
    ds: str | date,
    landing_root: str | None = None,
    replace: bool = True,
    inclusive_end: bool = False,
    partition_day: str | None = None,
    run_ts: datetime | None = None,
) -> DataFrame | None:
    """One day: daily figures, appended to the daily table and merged into the cumulative one. Returns the latter.

    Of two runs on the same tables at a time one raises ``RunsOverlap``, before it writes. With ``landing_root``, a day
    without logs is skipped and None comes back. ``run_ts`` is the time both tables are
    stamped with, by default the scheduled time of the day. ``partition_day``: see ``daily_calc``.
    """
    if inclusive_end and replace:
        # The next midnight's rows carry the next day's upload date and would replace that day's partition.
        raise ValueError("inclusive_end needs replace=False")
    day = as_day(ds)
    if landing_root and not landing_gate(tables.spark, landing_root, day):
        return None
    stamp = run_ts or run_time(day)
    daily = daily_calc(events, day, tables.metrics, ntz(stamp), inclusive_end, partition_day)
    with tables.lease():
        staged = tables.stage_daily(daily)
        tables.append_daily(staged, [day], replace)
        return tables.upsert(staged, day, day, stamp)


def run_days(
    tables: CalcTables,
    events: DataFrame,
    start: str | date,
    end: str | date,
    landing_root: str | None = None,
    partition_day: str | None = None,
) -> DataFrame | None:
    """``run_day`` over the days of [start, end), in order: all daily rows and a snapshot per day."""
    latest = None
    for day in days(start, end):
        done = run_day(tables, events, day, landing_root, partition_day=partition_day)
        latest = latest if done is None else done
    return latest


def backfill(
    tables: CalcTables,
    events: DataFrame,
    start: str | date,
    end: str | date,
    landing_root: str | None = None,
    partition_day: str | None = None,
) -> DataFrame | None:
    """The daily rows and the last snapshot that ``run_days`` gives, from one aggregate over all the days.

    Holds because the metrics merge and each row belongs to one upload day. Intermediate snapshots are not written, and
    those of earlier runs are dropped; a later run of a day in between starts from the daily rows.
    """
    run_over = days(start, end)
    if landing_root:
        landed = landing_inventory(tables.spark, landing_root, run_over).select("log_date")
        run_over = sorted(row["log_date"] for row in landed.collect())
        events = events.where(F.to_date("upload_time").isin(run_over))
    if not run_over:
        return None
    last = run_over[-1]
    stamp = run_time_of(F.col("upload_date"))
    daily = daily_range(events, start, end, tables.metrics, stamp, partition_day=partition_day)
    with tables.lease():
        staged = tables.stage_daily(daily)
        tables.append_daily(staged, run_over)
        stamped = staged.withColumn("update_time", ntz(run_time(last)))
        return tables.upsert(stamped, run_over[0], last, run_time(last))
