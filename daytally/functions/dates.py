"""Run dates and day ranges."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the daily run starts at 17:36.
RUN_AT = time(17, 36)


def as_day(ds: str | date) -> date:
    return date.fromisoformat(ds) if isinstance(ds, str) else ds


def next_day(ds: str | date) -> date:
    return as_day(ds) + timedelta(days=1)


def nodash(ds: str | date) -> str:
    return as_day(ds).strftime("%Y%m%d")


def days(start: str | date, end: str | date) -> list[date]:
    """The days of [start, end)."""
    first = as_day(start)
    return [first + timedelta(days=n) for n in range((as_day(end) - first).days)]


def ntz(moment: datetime | date) -> Column:
    """A timestamp literal without time zone."""
    if not isinstance(moment, datetime):
        moment = datetime.combine(moment, time())
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def run_time(ds: str | date) -> datetime:
    return datetime.combine(as_day(ds), RUN_AT)


def run_time_of(day: Column) -> Column:
    """The same as ``run_time`` for a date column."""
    return day.cast("timestamp_ntz") + F.expr(f"INTERVAL '{RUN_AT.isoformat()}' HOUR TO SECOND")


def in_days(moment: Column, start: str | date, end: str | date, inclusive_end: bool = False) -> Column:
    """Whether ``moment`` falls on one of the days of [start, end).

    The bounds are compared with the raw column, so that the predicate reaches the file scan. ``inclusive_end`` also
    takes the midnight that opens ``end``, as BETWEEN does; such a row then counts for two days.
    """
    upper = ntz(as_day(end))
    return (moment >= ntz(as_day(start))) & ((moment <= upper) if inclusive_end else (moment < upper))


def on_days(day: Column, start: str | date, end: str | date, inclusive_end: bool = False) -> Column:
    """``in_days`` for the date of a moment: a superset of its rows, for pruning partitions."""
    upper = F.lit(as_day(end))
    return (day >= F.lit(as_day(start))) & ((day <= upper) if inclusive_end else (day < upper))


def local_wall_clock(instant: Column, tz: str) -> Column:
    """An instant (TIMESTAMP) as the wall clock of ``tz`` (TIMESTAMP_NTZ). Apply once, at ingest."""
    return F.convert_timezone(F.current_timezone(), F.lit(tz), instant.cast("timestamp_ntz"))
