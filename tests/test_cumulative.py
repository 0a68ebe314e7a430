from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import exchanges, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daytally.functions.metrics import EventCount, Latest
from daytally.operators.cumulative import (
    insert_new_users,
    left_join_keys,
    merge_staging,
    update_from,
    upsert,
)
from daytally.workload.queries import LATE_DAY, SECOND_DAY, good_daily, previous_of

SF = "/root/testdata/sf0.01"
RUN = datetime(2024, 1, 2, 17, 36)
OLD = datetime(2024, 1, 1, 17, 36)
SCHEMA = (
    "user_id string, event_count long, total_value decimal(18,2), last_seen timestamp_ntz, update_time timestamp_ntz"
)


def table(spark, *figures, at=OLD):
    return spark.createDataFrame(
        [(user, n, Decimal(total), datetime(2024, 1, seen), at) for user, n, total, seen in figures], SCHEMA
    )


def test_distinct_union_loses_equal_rows_of_two_dates(spark):
    previous = table(spark, ("a", 5, "1.00", 1))
    daily = table(spark, ("a", 2, "0.50", 2), ("a", 2, "0.50", 2), at=RUN)
    assert rows(merge_staging(previous, daily), "event_count") == [(9,)]
    assert rows(merge_staging(previous, daily, distinct=True), "event_count") == [(7,)]


def test_distinct_union_takes_one_shuffle(spark):
    previous, daily = table(spark, ("a", 5, "1.00", 1)), table(spark, ("a", 2, "0.50", 2), at=RUN)
    assert exchanges(merge_staging(previous, daily, distinct=True)) == ["hashpartitioning"]


@pytest.mark.parametrize("distinct", [False, True])
def test_a_side_that_is_partitioned_by_user_is_not_shuffled_again(spark, distinct):
    previous = table(spark, ("a", 5, "1.00", 1), ("b", 1, "1.00", 1)).repartition(4, "user_id")
    daily = table(spark, ("a", 2, "0.50", 2), ("a", 2, "0.50", 2), at=RUN)
    merged = merge_staging(previous, daily, distinct=distinct, buckets=4)
    assert exchanges(merged) == ["hashpartitioning"] * 2  # the two repartitions, and none after the union
    assert rows(merged) == rows(merge_staging(previous, daily, distinct=distinct))


def test_update_from_keeps_only_old_users(spark):
    previous = table(spark, ("a", 1, "1.00", 1), ("b", 1, "1.00", 1))
    staging = merge_staging(previous, table(spark, ("a", 2, "0.25", 2), ("c", 1, "3.00", 2), at=RUN))
    updated = update_from(previous, staging, RUN)
    assert rows(updated, "user_id", "event_count", "update_time") == [("a", 3, RUN), ("b", 1, RUN)]


def test_insert_new_users_never_takes_a_null_key(spark):
    previous = table(spark, ("a", 1, "1.00", 1))
    staging = table(spark, ("a", 2, "2.00", 2), (None, 7, "1.00", 2), ("c", 1, "3.00", 2), at=RUN)
    assert rows(insert_new_users(previous, staging), "user_id") == [("c",)]
    assert rows(insert_new_users(previous.limit(0), staging), "user_id") == [("a",), ("c",)]


def test_left_join_keeps_unmatched_old_users(spark):
    previous = table(spark, ("a", 1, "1.00", 1), ("b", 1, "1.00", 1))
    daily = table(spark, ("b", 1, "1.00", 2), ("b", 1, "1.00", 2), ("z", 1, "1.00", 2))
    assert rows(left_join_keys(previous, daily)) == [("a", None), ("b", "b"), ("b", "b")]


def test_upsert_stamps_all_old_users_active_or_not(spark):
    previous = table(spark, ("a", 1, "1.00", 1), ("idle", 4, "2.50", 1))
    daily = table(spark, ("a", 2, "0.25", 2), ("new", 3, "1.75", 2), (None, 9, "9.00", 2), at=datetime(2024, 1, 2, 1))
    assert rows(upsert(previous, daily, RUN)) == [
        ("a", 3, Decimal("1.25"), datetime(2024, 1, 2), RUN),
        ("idle", 4, Decimal("2.50"), datetime(2024, 1, 1), RUN),
        ("new", 3, Decimal("1.75"), datetime(2024, 1, 2), datetime(2024, 1, 2, 1)),
    ]


def test_upsert_takes_a_chosen_list_of_metrics(spark):
    previous, daily = table(spark, ("a", 1, "1.00", 1)), table(spark, ("a", 2, "0.25", 2), at=RUN)
    merged = upsert(previous, daily, RUN, (EventCount(), Latest()))
    assert merged.columns == ["user_id", "event_count", "last_seen", "update_time"]
    assert rows(merged) == [("a", 3, datetime(2024, 1, 2), RUN)]


@pytest.mark.parametrize("ds", [SECOND_DAY, LATE_DAY])
@pytest.mark.parametrize("dirty", [False, True])
def test_upsert_is_update_plus_insert(spark, ds: date, dirty):
    previous, daily = previous_of(spark, SF, ds, dirty), good_daily(spark, SF, ds, dirty)
    staging = merge_staging(previous, daily)
    run = datetime(ds.year, ds.month, ds.day, 17, 36)
    steps = update_from(previous, staging, run).unionByName(insert_new_users(previous, staging))
    assert rows(upsert(previous, daily, run)) == rows(steps)
    assert rows(upsert(previous, daily, run, buckets=5)) == rows(steps)


FIGURES = st.tuples(
    st.sampled_from("abcdef"), st.integers(1, 50), st.decimals(0, 100, places=2).map(str), st.integers(1, 28)
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FIGURES, max_size=6, unique_by=lambda f: f[0]), st.lists(FIGURES, max_size=12))
def test_upsert_equals_a_plain_loop(spark, old, new):
    want = {}
    for known, figures in ((True, old), (False, new)):
        for user, n, total, seen in figures:
            have = want.setdefault(user, [0, Decimal(0), 1, known])
            want[user] = [have[0] + n, have[1] + Decimal(total), max(have[2], seen), have[3]]
    expected = sorted(
        (user, n, total.quantize(Decimal("0.01")), datetime(2024, 1, seen), RUN if known else OLD)
        for user, (n, total, seen, known) in want.items()
    )
    assert rows(upsert(table(spark, *old), table(spark, *new), RUN)) == expected
