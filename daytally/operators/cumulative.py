"""The cumulative per-user aggregate: its steps one by one, and the whole upsert in two plans.

``previous`` is the stored table, one row per user; ``daily`` holds daily rows; ``staging`` is the merge of the two.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.dates import ntz
from daytally.functions.metrics import DEFAULT_METRICS, Metric, folds, state_names

KEY = "user_id"


def cumulative_columns(metrics: tuple[Metric, ...]) -> list[str]:
    return [KEY, *state_names(metrics), "update_time"]


def _stack(previous: DataFrame, daily: DataFrame, buckets: int | None) -> DataFrame:
    """Union of old rows and the day's rows.

    Where ``previous`` is partitioned by user, as a table bucketed by user is, its bucket count lets the day's rows move
    to the buckets and the old rows, by far the larger side, stay where they are: what groups the union by user needs
    no other shuffle, and its result comes out in buckets too.
    """
    # The alias drops the table's name from the column. With it, Spark does not see that both sides of the union are
    # partitioned alike, and shuffles them.
    columns = [F.col(KEY).alias(KEY), *previous.columns[1:]]
    if buckets:
        daily = daily.repartition(buckets, KEY)
    return previous.select(columns).unionByName(daily)


def merge_staging(
    previous: DataFrame,
    daily: DataFrame,
    metrics: tuple[Metric, ...] = DEFAULT_METRICS,
    distinct: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Union of old rows and the day's rows, regrouped by user. ``buckets``: see ``upsert``.

    ``distinct`` drops equal rows first, as UNION does. Daily rows have lost their dates by then, so two dates of a user
    with equal figures collapse into one and the sums come out low; the default keeps all rows.
    """
    columns = cumulative_columns(metrics)
    rows = _stack(previous.select(columns), daily.select(columns), buckets)
    if distinct:
        # Spread by user before the de-duplication: both it and the regrouping then run on this one shuffle.
        rows = rows.distinct() if buckets else rows.repartition(KEY).distinct()
    return rows.groupBy(KEY).agg(*folds(metrics), F.max("update_time").alias("update_time"))


def update_from(
    previous: DataFrame,
    staging: DataFrame,
    run_ts: datetime,
    metrics: tuple[Metric, ...] = DEFAULT_METRICS,
) -> DataFrame:
    """The old users, with the staged figures and the run's time."""
    return previous.select(KEY).join(staging, KEY, "inner").select(
        KEY, *state_names(metrics), ntz(run_ts).alias("update_time")
    )


def insert_new_users(
    previous: DataFrame, staging: DataFrame, metrics: tuple[Metric, ...] = DEFAULT_METRICS
) -> DataFrame:
    """The staged users the table lacks.

    Equals NOT IN over the table's non-null keys, which rejects a NULL user. A plain anti-join may shuffle; NOT IN
    would copy the whole key list to every task.
    """
    return (
        staging.where(F.col(KEY).isNotNull())
        .join(previous.select(KEY), KEY, "left_anti")
        .select(*cumulative_columns(metrics))
    )


def left_join_keys(previous: DataFrame, other: DataFrame) -> DataFrame:
    """Old users with their matches in ``other``, all old users kept."""
    return (
        previous.select(KEY)
        .join(other.select(F.col(KEY).alias("b_user_id")), F.col(KEY) == F.col("b_user_id"), "left")
        .select(KEY, "b_user_id")
    )


def upsert(
    previous: DataFrame,
    daily: DataFrame,
    run_ts: datetime,
    metrics: tuple[Metric, ...] = DEFAULT_METRICS,
    buckets: int | None = None,
) -> DataFrame:
    """The table after UPDATE and INSERT, in one aggregate: no join, and each side read once.

    Staging holds all old users and all new ones, so the two statements leave exactly the staging rows. Old users get
    the run's time, new ones the latest of their rows.

    ``buckets`` is the partition count of a ``previous`` that is partitioned by user, such as the bucket count of a
    table; only the day's rows are shuffled then. Without it both sides are, after partial aggregation.
    """
    columns = cumulative_columns(metrics)
    old = previous.select(*columns, F.lit(True).alias("known"))
    new = daily.where(F.col(KEY).isNotNull()).select(*columns, F.lit(False).alias("known"))
    merged = (
        _stack(old, new, buckets)
        .groupBy(KEY)
        .agg(*folds(metrics), F.max("update_time").alias("update_time"), F.max("known").alias("known"))
    )
    stamp = F.when(F.col("known"), ntz(run_ts)).otherwise(F.col("update_time"))
    return merged.select(KEY, *state_names(metrics), stamp.alias("update_time"))
