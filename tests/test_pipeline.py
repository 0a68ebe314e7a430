from datetime import date, datetime

import pytest
from helpers import exchanges, plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daytally.functions.dates import days
from daytally.functions.metrics import EventCount, Latest
from daytally.operators.cumulative import upsert
from daytally.operators.daily import daily_calc
from daytally.plans.deltas import DeltaTables
from daytally.plans.pipeline import backfill, run_day, run_days
from daytally.plans.tables import CalcTables, recreate_staging
from daytally.session import run_dir
from daytally.workload.views import log_tree, uploads

SF = "/root/testdata/sf0.001"
D1, D2, D3, D4 = days("2024-01-01", "2024-01-05")


def both(tables):
    spark = tables.spark
    return rows(spark.table(tables.daily)), rows(spark.table(tables.final))


@pytest.fixture
def other(spark, tables):
    return CalcTables(spark, f"{tables.database}_b", f"{tables.location}-b", buckets=3).create()


def test_creating_twice_keeps_rows(spark, tables):
    run_day(tables, uploads(spark, SF), D1)
    before = both(tables)
    tables.create()
    assert both(tables) == before


def test_a_table_without_dynamic_overwrite_is_refused(spark, tables):
    spark.sql(f"DROP TABLE {tables.daily}")
    spark.sql(f"CREATE TABLE {tables.daily} (id BIGINT, upload_date DATE) USING parquet PARTITIONED BY (upload_date)")
    with pytest.raises(ValueError, match="wipe other days"):
        tables.create()


def test_running_a_day_twice_changes_nothing(spark, tables):
    feed = uploads(spark, SF)
    run_days(tables, feed, D1, D3)
    before = both(tables)
    run_day(tables, feed, D2)
    assert both(tables) == before


def test_appending_a_day_twice_doubles_it_with_new_ids(spark, tables):
    feed = uploads(spark, SF)
    run_day(tables, feed, D1, replace=False)
    n = spark.table(tables.daily).count()
    run_day(tables, feed, D1, replace=False)
    ids = sorted(r["id"] for r in spark.table(tables.daily).select("id").collect())
    assert ids == list(range(1, 2 * n + 1))


def test_rerunning_an_older_day_gives_ids_above_all_others(spark, tables):
    feed = uploads(spark, SF)
    run_days(tables, feed, D1, D4)
    others = spark.table(tables.daily).where(F.col("upload_date") != D2).agg(F.max("id")).first()[0]
    run_day(tables, feed, D2)
    ids = [r["id"] for r in spark.table(tables.daily).collect()]
    assert len(ids) == len(set(ids))
    assert spark.table(tables.daily).where(F.col("upload_date") == D2).agg(F.min("id")).first()[0] == others + 1


def test_a_rerun_that_finds_the_day_empty_clears_it(spark, tables, events):
    feed = uploads(spark, SF)
    run_days(tables, feed, D1, D3)
    run_day(tables, feed.where(F.to_date("upload_time") != D2), D2)
    assert spark.table(tables.daily).where(F.col("upload_date") == D2).isEmpty()
    assert not spark.table(tables.daily).where(F.col("upload_date") == D1).isEmpty()
    run_day(tables, feed.limit(0), D1)
    assert spark.table(tables.final).where(F.col("as_of") == D1).isEmpty()


def test_days_one_by_one_equal_the_backfill(spark, tables, other):
    feed = uploads(spark, SF, dirty=True)
    stepwise = rows(run_days(tables, feed, D1, D4))
    at_once = rows(backfill(other, feed, D1, D4))
    assert stepwise == at_once
    assert rows(spark.table(tables.daily)) == rows(spark.table(other.daily))


def test_a_backfill_on_top_of_a_snapshot(spark, tables, other):
    feed = uploads(spark, SF)
    stepwise = rows(run_days(tables, feed, D1, "2024-01-06"))
    run_day(other, feed, D1)
    assert rows(backfill(other, feed, D2, "2024-01-06")) == stepwise
    assert rows(spark.table(tables.daily)) == rows(spark.table(other.daily))


def test_days_without_logs_are_skipped(spark, tables, other):
    feed, root = uploads(spark, SF), log_tree(spark, SF)
    assert run_day(tables, feed, "2023-12-31", root) is None
    assert both(tables) == ([], [])
    stepwise = run_days(tables, feed, "2023-12-30", D3, root)
    assert rows(stepwise) == rows(backfill(other, feed, "2023-12-30", D3, root))
    assert tables.partition_days(tables.final) == [D1, D2]
    assert backfill(other, feed, "2023-12-01", "2023-12-05", root) is None


def test_a_gated_day_is_not_in_the_way_of_the_next(spark, tables, events):
    feed = events(
        ("a", "2024-01-01 01:00:00", "2024-01-01 02:00:00", 1.0),
        ("a", "2024-01-03 01:00:00", "2024-01-03 02:00:00", 2.0),
    )
    run_day(tables, feed, D1)
    assert rows(run_day(tables, feed, D3), "event_count", "update_time") == [(2, datetime(2024, 1, 3, 17, 36))]


def test_the_run_time_can_be_given(spark, tables, events):
    now = datetime(2024, 1, 1, 23, 59, 1)
    feed = events(("a", "2024-01-01 01:00:00", "2024-01-01 02:00:00", 1.0))
    assert rows(run_day(tables, feed, D1, run_ts=now), "update_time") == [(now,)]
    assert rows(spark.table(tables.daily), "update_time") == [(now,)]


def test_partition_pruning_gives_the_same_run(spark, tables, other, tmp_path):
    path = str(tmp_path / "lake")
    feed = uploads(spark, SF).withColumn("upload_date", F.to_date("upload_time"))
    feed.write.partitionBy("upload_date").parquet(path)
    lake = spark.read.parquet(path)
    assert rows(run_days(tables, lake, D1, D3, partition_day="upload_date")) == rows(run_days(other, feed, D1, D3))
    plan = plan_of(daily_calc(lake, D2, partition_day="upload_date"))
    assert "PartitionFilters: [isnotnull(upload_date" in plan and "InMemoryFileIndex(32 paths)" not in plan


def test_rejects_stay_out_of_both_tables(spark, tables, events):
    feed = events(
        ("a", "2024-01-01 01:00:00", "2024-01-01 02:00:00", 1.0),
        (None, "2024-01-01 01:00:00", "2024-01-01 02:00:00", 1.0),
        ("x" * 21, "2024-01-01 01:00:00", "2024-01-01 02:00:00", 1.0),
    )
    assert rows(run_day(tables, feed, D1), "user_id") == [("a",)]
    assert rows(spark.table(tables.daily), "id", "user_id") == [(1, "a")]
    assert rows(tables.rejected(), "broken_rule") == [("user_id is null",), ("user_id longer than 20",)]


def test_inclusive_end_needs_append(spark, tables, events):
    feed = events(("a", "2024-01-01 10:00:00", "2024-01-02 00:00:00", 1.0))
    with pytest.raises(ValueError):
        run_day(tables, feed, D1, inclusive_end=True)
    for day in (D1, D2):
        run_day(tables, feed, day, replace=False, inclusive_end=True)
    assert spark.table(tables.daily).count() == 2
    assert rows(tables.snapshot(D2), "event_count") == [(2,)]


@pytest.mark.parametrize("kind", [CalcTables, DeltaTables])
def test_appended_days_count_alike_with_and_without_old_snapshots(spark, events, kind):
    """A day that ran twice, and midnight rows that two runs take."""
    feed = events(("a", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 1.0), ("a", "2024-01-01 23:00:00", "2024-01-02 00:00:00", 2.0), ("a", "2024-01-02 10:00:00", "2024-01-02 12:00:00", 4.0))
    found = []
    for dropped in (False, True):
        for run in ("twice", "inclusive"):
            name = run_dir(spark, "tables")
            tables = kind(spark, "calc_" + name.rpartition("-")[2], name, buckets=2).create()
            inclusive = run == "inclusive"
            for _ in range(1 if inclusive else 2):
                run_day(tables, feed, D1, replace=False, inclusive_end=inclusive)
            if dropped:
                tables.drop_snapshots_before(D2)
            last = run_day(tables, feed, D2, replace=False, inclusive_end=inclusive)
            found.append(rows(last, "event_count", F.col("total_value").cast("double")))
    assert found == [[(3, 7.0)], [(4, 9.0)]] * 2


def test_appended_rows_are_not_added_up(spark, tables, events):
    feed = events(("a", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 1.0), ("a", "2024-01-02 10:00:00", "2024-01-02 12:00:00", 4.0))
    for _ in range(2):
        run_day(tables, feed, D1, replace=False)
    spark.sql(f"ALTER TABLE {tables.final} DROP PARTITION (as_of = DATE '{D1}')")
    with pytest.raises(ValueError, match="appended days 2024-01-01"):
        run_day(tables, feed, D2)
    run_day(tables, feed, D1)  # replaced: its rows count once again
    spark.sql(f"ALTER TABLE {tables.final} DROP PARTITION (as_of = DATE '{D1}')")
    assert rows(run_day(tables, feed, D2), "event_count") == [(2,)]


def test_declared_lengths_and_defaults_hold_for_plain_inserts(spark, tables):
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {tables.daily} (id, user_id, upload_date) VALUES (1, repeat('u', 21), DATE '{D1}')")
    spark.sql(f"INSERT INTO {tables.daily} (id, user_id, upload_date) VALUES (1, 'u', DATE '{D1}')")
    assert spark.table(tables.daily).first()["update_time"] is not None


def test_staging_is_recreated_over_leftovers(spark, tables):
    name, path = tables.daily_temp, f"{tables.location}/user_daily_calc_temp"
    spark.range(5).write.parquet(path)
    assert recreate_staging(spark.range(3), name, path).count() == 3
    assert recreate_staging(spark.range(2).withColumnRenamed("id", "other"), name, path).columns == ["other"]
    assert spark.table(name).count() == 2


def test_the_snapshot_is_not_shuffled_and_has_a_file_per_bucket(spark, tables):
    feed = uploads(spark, SF)
    run_day(tables, feed, D1)
    staged = tables.spark.table(tables.daily_temp)
    merged = upsert(tables.snapshot(D1), staged, datetime(2024, 1, 2), tables.metrics, tables.buckets)
    assert "Bucketed: true" in plan_of(merged)
    assert exchanges(merged) == ["hashpartitioning"]  # the day's rows; the old rows stay in their buckets
    assert len(spark.table(tables.final).inputFiles()) <= tables.buckets


def test_another_bucket_count_leaves_the_result_alone(spark, tables):
    feed = uploads(spark, SF)
    run_day(tables, feed, D1)
    changed = CalcTables(spark, tables.database, tables.location, buckets=9).create()
    assert changed.stored_buckets() == 4
    before = rows(run_day(tables, feed, D2))
    assert rows(run_day(changed, feed, D2)) == before


def test_a_run_that_died_between_reserving_and_writing_leaves_a_gap(spark, tables):
    feed = uploads(spark, SF)
    spark.sql(f"INSERT INTO {tables.id_sequence} VALUES (100, DATE '{D1}')")
    run_day(tables, feed, D2)
    assert spark.table(tables.daily).agg(F.min("id")).first()[0] == 101
    run_day(tables, feed, D1)
    ids = [r["id"] for r in spark.table(tables.daily).select("id").collect()]
    assert len(ids) == len(set(ids))


def test_a_run_that_died_half_way_is_made_good_by_a_rerun(spark, tables, other):
    feed = uploads(spark, SF)
    for one in (tables, other):
        run_day(one, feed, D1)
    staged = tables.stage_daily(daily_calc(feed, D2))
    tables.append_daily(staged, [D2])  # and no upsert
    assert rows(run_day(tables, feed, D2)) == rows(run_day(other, feed, D2))
    assert both(tables) == both(other)


def test_latest_is_the_last_snapshot(spark, tables):
    assert tables.latest().isEmpty()
    last = run_days(tables, uploads(spark, SF), D1, D3)
    assert rows(tables.latest()) == rows(last)


def test_old_snapshots_can_be_dropped(spark, tables):
    feed = uploads(spark, SF)
    run_days(tables, feed, D1, D4)
    kept = rows(tables.snapshot(D3))
    tables.drop_snapshots_before(D2)
    assert tables.partition_days(tables.final) == [D2, D3]
    assert rows(run_day(tables, feed, D3)) == kept


def test_one_day_reads_one_snapshot(spark, tables):
    run_days(tables, uploads(spark, SF), D1, D4)
    snapshot = tables.snapshot(tables.snapshot_before(D3))
    assert f"as_of={D2}" in plan_of(snapshot) and f"as_of={D1}" not in plan_of(snapshot)
    assert tables.snapshot_before(D1) is None
    assert tables.snapshot_before(date(2030, 1, 1)) == D3


# Runs of earlier days


def without(feed, day, late):
    """The feed as it was before some uploads of a day came in."""
    return feed.where(~((F.to_date("upload_time") == F.lit(day)) & late))


def test_a_run_after_a_backfill_starts_from_the_corrected_days(spark, tables, other):
    feed, late = uploads(spark, SF), F.col("event_id") % 2 == 0
    run_days(tables, without(feed, D1, late), D1, D3)
    backfill(tables, feed, D1, D3)
    assert tables.partition_days(tables.final) == [D2]
    again = run_day(tables, feed, D2)
    assert rows(again) == rows(run_days(other, feed, D1, D3)) == rows(tables.latest())


def test_a_rerun_of_an_old_day_leaves_no_later_snapshot(spark, tables, other):
    feed, late = uploads(spark, SF), F.col("event_id") % 2 == 0
    run_days(tables, without(feed, D1, late), D1, D4)
    corrected = run_day(tables, feed, D1)
    assert tables.partition_days(tables.final) == [D1]
    assert rows(tables.latest()) == rows(corrected) == rows(run_day(other, feed, D1))
    run_days(other, feed, D2, D4)
    assert rows(run_day(tables, feed, D3)) == rows(other.latest())


def test_rebucketing_moves_the_latest_snapshot(spark, tables):
    feed = uploads(spark, SF)
    run_days(tables, feed, D1, D3)
    before = rows(tables.latest())
    tables.rebucket(7)
    assert tables.create().stored_buckets() == 7 and rows(tables.latest()) == before
    assert tables.partition_days(tables.final) == [D2]
    after = rows(run_day(tables, feed, D3))
    assert len(after) >= len(before)
    tables.rebucket(3)
    assert tables.stored_buckets() == 3 and rows(tables.latest()) == after


def test_rebucketing_an_empty_table(spark, tables):
    tables.rebucket(5)
    assert tables.stored_buckets() == 5 and tables.latest().isEmpty()


@pytest.mark.parametrize("metrics", [(Latest(), EventCount()), (EventCount(),), (EventCount(), Latest("last", "start_time"))])
def test_other_columns_are_refused(spark, tables, metrics):
    spark.sql(f"CREATE DATABASE {tables.database}_m LOCATION '{tables.location}-m'")
    CalcTables(spark, f"{tables.database}_m", f"{tables.location}-m", 4, (EventCount(), Latest())).create()
    with pytest.raises(ValueError, match="other columns"):
        CalcTables(spark, f"{tables.database}_m", f"{tables.location}-m", 4, metrics).create()


def test_the_staged_rows_are_counted_once(spark, tables):
    """The day counts and the id offsets come from one aggregate."""
    staged = tables.stage_daily(daily_calc(uploads(spark, SF), D1))
    tables.append_daily(staged, [D1])
    ids = sorted(r["id"] for r in spark.table(tables.daily).select("id").collect())
    assert ids == list(range(1, len(ids) + 1))
