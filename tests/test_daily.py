from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import exchanges, plan_of, rows
from pyspark.errors import ArithmeticException, PySparkException
from pyspark.sql import functions as F

from daytally.functions.dates import days, in_days, local_wall_clock, next_day, nodash, ntz, run_time
from daytally.functions.metrics import FixedSum
from daytally.operators.daily import daily_calc
from daytally.workload.views import uploads

SF = "/root/testdata/sf0.01"


def test_run_dates():
    assert nodash("2024-02-29") == "20240229"
    assert next_day("2024-12-31") == date(2025, 1, 1)
    assert run_time("2024-01-02") == datetime(2024, 1, 2, 17, 36)
    assert days("2024-01-30", "2024-02-02") == [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)]


def test_groups_by_user_event_date_and_upload_date(events):
    feed = events(
        ("a", "2024-01-02 01:00:00", "2024-01-02 02:00:00", 1.10),
        ("a", "2024-01-02 03:00:00", "2024-01-02 04:00:00", 2.25),
        ("a", "2024-01-01 23:00:00", "2024-01-02 05:00:00", 0.05),
        ("b", "2024-01-02 03:00:00", "2024-01-03 00:00:00", 9.00),
    )
    total = F.col("total_value").cast("double")
    assert rows(daily_calc(feed, "2024-01-02"), "user_id", "event_date", "event_count", total) == [
        ("a", date(2024, 1, 1), 1, 0.05),
        ("a", date(2024, 1, 2), 2, 3.35),
    ]


def test_midnight_counts_once_by_default_and_twice_when_inclusive(events):
    feed = events(("a", "2024-01-02 10:00:00", "2024-01-03 00:00:00", 1.0))
    counted = lambda **o: sum(daily_calc(feed, ds, **o).count() for ds in ("2024-01-02", "2024-01-03"))
    assert counted() == 1
    assert counted(inclusive_end=True) == 2


def test_days_cover_each_row_once(spark):
    feed = uploads(spark, SF)
    each = [in_days(F.col("upload_time"), day, next_day(day)) for day in days("2024-01-01", "2024-02-02")]
    assert sum(feed.select(*[F.count(F.when(one, 1)) for one in each]).first()) == 10_000


def test_null_users_form_a_group(events):
    feed = events(
        (None, "2024-01-02 01:00:00", "2024-01-02 02:00:00", 1.0),
        (None, "2024-01-02 02:00:00", "2024-01-02 03:00:00", 1.0),
    )
    assert rows(daily_calc(feed, "2024-01-02"), "user_id", "event_count") == [(None, 2)]


def test_sum_rounds_to_cents_like_a_decimal_cast(spark, events):
    values = [1.005, 2.675, -1.005, 0.1, 0.2, 9999999999.99, None]
    feed = events(*[("a", "2024-01-02 01:00:00", "2024-01-02 02:00:00", v) for v in values])
    want = feed.agg(F.sum(F.col("value").cast("decimal(18,2)"))).first()[0]
    assert daily_calc(feed, "2024-01-02").first()["total_value"] == want


def test_a_value_that_does_not_fit_stops_the_run(events):
    feed = events(("a", "2024-01-02 01:00:00", "2024-01-02 02:00:00", 1e17))
    with pytest.raises(ArithmeticException):
        daily_calc(feed, "2024-01-02").collect()


@pytest.mark.parametrize("value", [float("nan"), float("inf")])
def test_what_is_no_number_stops_the_run(events, value):
    feed = events(*[("a", "2024-01-02 01:00:00", "2024-01-02 02:00:00", v) for v in (value, 1.0)])
    with pytest.raises(PySparkException):
        daily_calc(feed, "2024-01-02").collect()


def test_a_checked_sum_refuses_further_decimals(events):
    def total(*values):
        feed = events(*[("a", "2024-01-02 01:00:00", "2024-01-02 02:00:00", v) for v in values])
        return daily_calc(feed, "2024-01-02", (FixedSum(checked=True),)).first()["total_value"]

    assert total(0.1, 0.2, 1234567.89, None) == Decimal("1234568.19")
    with pytest.raises(PySparkException, match="does not fit"):
        total(1.005)


def test_range_reaches_the_scan_and_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "feed")
    uploads(spark, SF).write.parquet(path)
    daily = daily_calc(spark.read.parquet(path), "2024-01-05")
    plan = plan_of(daily)
    assert "GreaterThanOrEqual(upload_time,2024-01-05T00:00)" in plan
    assert "LessThan(upload_time,2024-01-06T00:00)" in plan
    assert "event_type" not in plan and "event_id" not in plan
    assert exchanges(daily) == ["hashpartitioning"]


def test_a_hot_user_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 200_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS user_id",
        "TIMESTAMP_NTZ '2024-01-02 01:00:00' AS start_time",
        "TIMESTAMP_NTZ '2024-01-02 02:00:00' AS upload_time",
        "0.01D AS value",
    )
    daily = daily_calc(hot, "2024-01-02")
    assert rows(daily.where("user_id = 'hot'"), "event_count") == [(66_667,)]
    assert "partial_count" in plan_of(daily)


def test_instants_become_wall_clock_once(spark):
    instant = spark.sql("SELECT TIMESTAMP '2024-01-01 17:00:00 UTC' AS at")
    local = instant.select(local_wall_clock(F.col("at"), "Asia/Taipei").alias("at"))
    assert local.schema["at"].dataType.typeName() == "timestamp_ntz"
    assert local.first()["at"] == datetime(2024, 1, 2, 1, 0)
    assert local.select(F.to_date("at")).first()[0] == date(2024, 1, 2)


def test_ntz_literal(spark):
    assert spark.range(1).select(ntz(datetime(2024, 1, 2, 3, 4, 5, 6))).first()[0] == datetime(2024, 1, 2, 3, 4, 5, 6)
