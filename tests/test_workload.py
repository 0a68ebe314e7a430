"""How the registered queries over many days read their feed."""

import re
from datetime import date, datetime, timedelta

from helpers import plan_of, rows

from daytally.operators.daily import daily_calc
from daytally.workload import queries
from daytally.workload.queries import BY_DAY, feed, q_run_days_inclusive, q_run_days_inclusive_all
from daytally.workload.views import uploads

D2, D3 = date(2024, 1, 2), date(2024, 1, 3)


def write_events(spark, folder, n):
    """One event an hour from the first day's midnight on; a null time and a null user among them."""
    start = datetime(2024, 1, 1)
    made = [(i, None if i == 5 else start + timedelta(hours=i), None if i == 7 else i % 3, "view", 1.0) for i in range(n)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(made, kinds).write.mode("overwrite").parquet(f"{folder}/events.parquet")


def test_a_run_reads_the_files_of_its_days_only(spark, tmp_path):
    write_events(spark, tmp_path, 120)
    all_days = feed(spark, str(tmp_path))
    assert rows(all_days.drop(BY_DAY)) == rows(uploads(spark, str(tmp_path)))
    for inclusive, upper in ((False, "<"), (True, "<=")):
        daily = daily_calc(all_days, D2, inclusive_end=inclusive, partition_day=BY_DAY)
        pruned = re.search(r"PartitionFilters: \[(.*)\]", plan_of(daily))[1]
        assert re.search(rf"{BY_DAY}#\d+ >= 2024-01-02\).*{BY_DAY}#\d+ {upper} 2024-01-03\)", pruned)
        assert rows(daily) == rows(daily_calc(uploads(spark, str(tmp_path)), D2, inclusive_end=inclusive))


def test_a_feed_without_rows(spark, tmp_path):
    write_events(spark, tmp_path, 0)
    assert feed(spark, str(tmp_path)).count() == 0


def test_inclusive_queries_do_their_own_runs(spark, tmp_path, monkeypatch):
    """Other events in the same folder give other results, also within a session, and the other query takes nothing away."""
    monkeypatch.setattr(queries, "END", D3)
    counts = []
    for n in (24, 96):
        write_events(spark, tmp_path, n)
        final = q_run_days_inclusive(spark, str(tmp_path)).agg({"event_count": "sum"}).first()[0]
        daily = q_run_days_inclusive_all(spark, str(tmp_path)).agg({"event_count": "sum"}).first()[0]
        assert final == daily
        counts.append(daily)
    assert 0 < counts[0] < counts[1]
