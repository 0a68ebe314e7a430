"""The daily aggregate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.dates import in_days, next_day, ntz, on_days, run_time
from daytally.functions.metrics import DEFAULT_METRICS, Metric, per_day

DAILY_KEYS = ("user_id", "event_date", "upload_date")


def daily_calc(
    events: DataFrame,
    ds: str | date,
    metrics: tuple[Metric, ...] = DEFAULT_METRICS,
    update_time: Column | None = None,
    inclusive_end: bool = False,
    partition_day: str | None = None,
) -> DataFrame:
    """Figures per user, event date and upload date, over the rows uploaded on ``ds``.

    Late events stay visible: each upload day adds its own rows for the event dates it brings. ``partition_day`` names
    a date column that equals the date of ``upload_time`` in every row, such as a partition column; given one, only
    the partitions of the day are read.
    """
    stamp = ntz(run_time(ds)) if update_time is None else update_time
    return daily_range(events, ds, next_day(ds), metrics, stamp, inclusive_end, partition_day)


def daily_range(
    events: DataFrame,
    start: str | date,
    end: str | date,
    metrics: tuple[Metric, ...],
    update_time: Column,
    inclusive_end: bool = False,
    partition_day: str | None = None,
) -> DataFrame:
    """The same for all upload days of [start, end) in one aggregate; ``update_time`` may use ``upload_date``.

    One shuffle, of partial aggregates: however many rows a user has, a task sends one per user and pair of dates.
    """
    if partition_day:
        events = events.where(on_days(F.col(partition_day), start, end, inclusive_end))
    return (
        events.where(in_days(F.col("upload_time"), start, end, inclusive_end))
        .groupBy(
            "user_id",
            F.to_date("start_time").alias("event_date"),
            F.to_date("upload_time").alias("upload_date"),
        )
        .agg(*per_day(metrics))
        .withColumn("update_time", update_time)
    )
