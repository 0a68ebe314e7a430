"""The same queries in plain SQL over the ``events`` table, for checking results."""

from __future__ import annotations

from datetime import date, timedelta

from daytally.workload.queries import END, FIFTH_DAY, LATE_DAY, SECOND_DAY

METRICS = """COUNT(*) AS event_count,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       MAX(start_time) AS last_seen"""

RICH_METRICS = f"""{METRICS},
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS average_value,
       COUNT(DISTINCT event_type) AS event_types,
       quantile_disc(value, 0.5) AS median_value"""

MERGED_METRICS = """CAST(SUM(event_count) AS BIGINT) AS event_count,
       CAST(SUM(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       MAX(last_seen) AS last_seen"""

CLEAN_ID = "CAST(user_id AS VARCHAR)"
DIRTY_ID = """CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_id % 103 = 0 THEN lpad(CAST(user_id AS VARCHAR), 21, '0')
            ELSE CAST(user_id AS VARCHAR) END"""
GOOD_ID = "user_id IS NOT NULL AND length(user_id) <= 20"


DAY = timedelta(days=1)


def _ts(day: date) -> str:
    return f"TIMESTAMP '{day} 00:00:00'"


def _run(day: date) -> str:
    """The time that the run of a day stamps."""
    return f"TIMESTAMP '{day} 17:36:00'"


def _uploads(dirty: bool = False) -> str:
    return f"""uploads AS (
SELECT event_id, {DIRTY_ID if dirty else CLEAN_ID} AS user_id, ts AS start_time,
       CASE WHEN event_id % 97 = 0 THEN date_trunc('day', ts) + INTERVAL 1 DAY
            ELSE ts + to_hours(event_id % 48) END AS upload_time,
       event_type, value
FROM events)"""


def _daily(ds: date, end_operator: str = "<", where: str = "TRUE") -> str:
    return f"""daily_tmp AS (
SELECT user_id, CAST(start_time AS DATE) AS event_date,
       {METRICS},
       CAST(upload_time AS DATE) AS upload_date,
       {_run(ds)} AS update_time
FROM uploads
WHERE upload_time >= {_ts(ds)} AND upload_time {end_operator} {_ts(ds + DAY)} AND {where}
GROUP BY user_id, CAST(start_time AS DATE), CAST(upload_time AS DATE))"""


def _previous(ds: date) -> str:
    return f"""final_prev AS (
SELECT user_id,
       {METRICS},
       {_run(ds - DAY)} AS update_time
FROM uploads
WHERE {GOOD_ID} AND upload_time < {_ts(ds)}
GROUP BY user_id)"""


FINAL_TMP = f"""final_tmp AS (
SELECT user_id,
       {MERGED_METRICS},
       MAX(update_time) AS update_time
FROM (SELECT * FROM final_prev UNION ALL
      SELECT user_id, event_count, total_value, last_seen, update_time FROM daily_tmp) a
GROUP BY user_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def _cumulative(ds: date, select: str, dirty: bool = False) -> str:
    return f"{_with(_uploads(dirty), _daily(ds, where=GOOD_ID), _previous(ds), FINAL_TMP)}\n{select}"


def _union_distinct(ds: date) -> str:
    return _cumulative(
        ds,
        """SELECT user_id, CAST(SUM(event_count) AS BIGINT) AS event_count, MAX(update_time) AS update_time
FROM (SELECT user_id, event_count, update_time FROM final_prev UNION
      SELECT user_id, event_count, update_time FROM daily_tmp) a
GROUP BY user_id""",
    )


def _update_from(ds: date) -> str:
    return _cumulative(
        ds,
        f"""SELECT user_id, a.event_count, a.total_value, a.last_seen, {_run(ds)} AS update_time
FROM final_prev f JOIN final_tmp a USING (user_id)""",
    )


def _upsert(ds: date, dirty: bool = False) -> str:
    return _cumulative(
        ds,
        f"""SELECT a.user_id, a.event_count, a.total_value, a.last_seen,
       CASE WHEN f.user_id IS NULL THEN a.update_time ELSE {_run(ds)} END AS update_time
FROM final_tmp a LEFT JOIN final_prev f ON a.user_id = f.user_id""",
        dirty,
    )


INSERT_NEW = """SELECT user_id, event_count, total_value, last_seen, update_time FROM final_tmp
WHERE user_id NOT IN (SELECT user_id FROM final_prev)"""

LEFT_JOIN = """SELECT a.user_id, b.user_id AS b_user_id
FROM final_prev a LEFT JOIN daily_tmp b ON a.user_id = b.user_id"""


def _closed_form(end: date, where: str = "TRUE", metrics: str = METRICS) -> str:
    return f"""{_with(_uploads())}
SELECT user_id,
       {metrics},
       {_run(end - DAY)} AS update_time
FROM uploads WHERE upload_time < {_ts(end)} AND {where} GROUP BY user_id"""


BACKFILL_DAILY = f"""{_with(_uploads(dirty=True))}
SELECT row_number() OVER (ORDER BY upload_date, user_id, event_date) AS id,
       user_id, event_date, event_count, total_value, last_seen, upload_date,
       CAST(upload_date AS TIMESTAMP) + INTERVAL '17 hours 36 minutes' AS update_time
FROM (SELECT user_id, CAST(start_time AS DATE) AS event_date, CAST(upload_time AS DATE) AS upload_date,
       {METRICS}
      FROM uploads WHERE {GOOD_ID} GROUP BY ALL) d"""

DAILY_FIGURES = f"""{_with(_uploads())}
SELECT user_id, CAST(start_time AS DATE) AS event_date, CAST(upload_time AS DATE) AS upload_date,
       {RICH_METRICS},
       CAST(CAST(upload_time AS DATE) AS TIMESTAMP) + INTERVAL '17 hours 36 minutes' AS update_time
FROM uploads GROUP BY user_id, CAST(start_time AS DATE), CAST(upload_time AS DATE)"""

DAILY_APPEND = f"""{_with(_uploads(), _daily(FIFTH_DAY))}
SELECT row_number() OVER (ORDER BY user_id, event_date, upload_date) AS id,
       user_id, event_date, event_count, total_value, last_seen, upload_date, update_time
FROM daily_tmp"""

VIOLATIONS = f"""{_with(_uploads(dirty=True))}
SELECT rule, COUNT(*) AS n_rows
FROM (SELECT CASE WHEN user_id IS NULL THEN 'user_id is null'
                  WHEN length(user_id) > 20 THEN 'user_id longer than 20' END AS rule
      FROM uploads) r
WHERE rule IS NOT NULL GROUP BY rule"""

LANDED = "event_id, user_id, start_time, upload_time, event_type, value, CAST(upload_time AS DATE) AS upload_date"

ALL_UPLOADS = f"{_with(_uploads())}\nSELECT {LANDED} FROM uploads"

SECOND_DAY_UPLOADS = f"""{_with(_uploads())},
day_rows AS (SELECT {LANDED} FROM uploads WHERE CAST(upload_time AS DATE) = DATE '{SECOND_DAY}')"""

WAREHOUSE_ROWS = "SELECT *, CAST(start_time AS DATE) AS event_day FROM day_rows"

LINES = f"""{_with(_uploads())},
lines AS (SELECT CAST(upload_time AS DATE) AS log_date,
       '{{"event_id":' || event_id || ',"user_id":"' || user_id
       || '","start_time":"' || strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f')
       || '","upload_time":"' || strftime(upload_time, '%Y-%m-%dT%H:%M:%S.%f')
       || '","event_type":"' || event_type || '","value":' || value || '}}' AS line FROM uploads)"""

# A stray folder repeats the lines of 5 January under names that are no date; no job takes it.
INGEST_SIZED = f"""{LINES}
SELECT log_date, CAST(SUM(strlen(line) + 1) AS BIGINT) AS total_bytes,
       CASE WHEN SUM(strlen(line) + 1) > 100000 THEN 4 ELSE 2 END AS writers, TRUE AS within
FROM lines GROUP BY log_date"""

# Each run takes its day and the midnight after it.
INCLUSIVE_RUNS = f"""{_with(_uploads())},
runs AS (SELECT CAST(d AS TIMESTAMP) AS d FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '{END - DAY}', INTERVAL 1 DAY) t(d)),
taken AS (SELECT * FROM uploads JOIN runs ON upload_time >= d AND upload_time <= d + INTERVAL 1 DAY)"""

INCLUSIVE_DAILY = f"""{INCLUSIVE_RUNS}
SELECT user_id, CAST(start_time AS DATE) AS event_date,
       {METRICS},
       CAST(upload_time AS DATE) AS upload_date, d + INTERVAL '17 hours 36 minutes' AS update_time
FROM taken GROUP BY user_id, CAST(start_time AS DATE), CAST(upload_time AS DATE), d"""

INCLUSIVE_FINAL = f"""{INCLUSIVE_RUNS}
SELECT user_id,
       {METRICS},
       {_run(END - DAY)} AS update_time
FROM taken GROUP BY user_id"""

ORACLES: dict[str, str] = {
    "daily_calc": f"{_with(_uploads(), _daily(FIFTH_DAY))}\nSELECT * FROM daily_tmp",
    "daily_calc_inclusive": f"{_with(_uploads(), _daily(FIFTH_DAY, '<='))}\nSELECT * FROM daily_tmp",
    "daily_figures": DAILY_FIGURES,
    "upsert_figures": _closed_form(END, metrics=RICH_METRICS),
    "recreate_staging": f"{_with(_uploads(), _daily(SECOND_DAY))}\nSELECT * FROM daily_tmp",
    "daily_append": DAILY_APPEND,
    "backfill_daily": BACKFILL_DAILY,
    "union_distinct_final": _union_distinct(SECOND_DAY),
    "union_distinct_final_late": _union_distinct(LATE_DAY),
    "union_all_final": _cumulative(SECOND_DAY, "SELECT * FROM final_tmp"),
    "union_all_final_late": _cumulative(LATE_DAY, "SELECT * FROM final_tmp"),
    "update_from": _update_from(SECOND_DAY),
    "update_from_late": _update_from(LATE_DAY),
    "insert_new_users": _cumulative(SECOND_DAY, INSERT_NEW),
    "insert_new_users_dirty": _cumulative(SECOND_DAY, INSERT_NEW, dirty=True),
    "left_join_keys": _cumulative(SECOND_DAY, LEFT_JOIN),
    "left_join_keys_late": _cumulative(LATE_DAY, LEFT_JOIN),
    "upsert_final": _upsert(SECOND_DAY),
    "upsert_final_dirty": _upsert(SECOND_DAY, dirty=True),
    "upsert_final_late": _upsert(LATE_DAY),
    "upsert_bucketed": _upsert(LATE_DAY, dirty=True),
    "run_days": _closed_form(END),
    "run_days_deltas": _closed_form(END),
    "correct_day": _closed_form(END),
    "run_days_gated": _closed_form(END),
    "run_days_inclusive": INCLUSIVE_FINAL,
    "run_days_inclusive_all": INCLUSIVE_DAILY,
    "rerun_after_backfill": _closed_form(END),
    "rerun_after_backfill_all": _closed_form(END),
    "backfill_closed_form": _closed_form(END),
    "constraint_violations": VIOLATIONS,
    "duplicate_keys": f"""{_with(_uploads())}
SELECT user_id, COUNT(*) AS n_rows FROM uploads GROUP BY user_id HAVING COUNT(*) > 1""",
    "ingest_logs": ALL_UPLOADS,
    "ingest_good": f"{ALL_UPLOADS} WHERE event_id % 50 <> 0",
    "ingest_rejects": f"""{_with(_uploads())}
SELECT 'garbage ' || event_id AS line, CAST(upload_time AS DATE) AS upload_date
FROM uploads WHERE event_id % 50 = 0""",
    "ingest_days": ALL_UPLOADS,
    "ingest_sized": INGEST_SIZED,
    "lake_partition_read": f"{SECOND_DAY_UPLOADS}\nSELECT * FROM day_rows",
    "daily_calc_lake": f"{_with(_uploads(), _daily(FIFTH_DAY))}\nSELECT * FROM daily_tmp",
    "logs_to_final": _closed_form(END, "event_id % 50 <> 0"),
    "warehouse_append": f"{SECOND_DAY_UPLOADS}\n{WAREHOUSE_ROWS}",
    "warehouse_append_twice": f"{SECOND_DAY_UPLOADS}\n{WAREHOUSE_ROWS} UNION ALL {WAREHOUSE_ROWS}",
    "warehouse_load_lake": f"""{_with(_uploads())}
SELECT {LANDED}, CAST(start_time AS DATE) AS event_day FROM uploads""",
    "warehouse_reclustered": f"""{_with(_uploads())}
SELECT {LANDED}, CAST(start_time AS DATE) AS event_day FROM uploads""",
    # Users of a day whose events were uploaded in two loads or more make two files overlap.
    "recluster_report": f"""{_with(_uploads())},
ranges AS (SELECT CAST(start_time AS DATE) AS event_day, date_diff('day', DATE '1970-01-01', CAST(upload_time AS DATE)) % 3 AS turn,
       MIN(ROW(user_id, start_time)) AS least, MAX(ROW(user_id, start_time)) AS most
FROM uploads GROUP BY ALL)
SELECT a.event_day, bool_or(b.turn IS NOT NULL) AS overlapped, CAST(0 AS BIGINT) AS n_overlapping, CAST(1 AS BIGINT) AS depth
FROM ranges a LEFT JOIN ranges b ON a.event_day = b.event_day AND a.turn <> b.turn AND a.least < b.most AND b.least < a.most
GROUP BY a.event_day""",
    "landing_inventory": f"""{LINES}
SELECT log_date, CAST(SUM(strlen(line) + 1) AS BIGINT) AS total_bytes FROM lines GROUP BY log_date""",
    "landing_gate": f"""{_with(_uploads())}
SELECT CAST(d AS DATE) AS log_date,
       CAST(d AS DATE) IN (SELECT CAST(upload_time AS DATE) FROM uploads) AS landed
FROM generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-04', INTERVAL 1 DAY) t(d)""",
    "input_size_profile": f"""{LINES}
SELECT CAST(SUM(strlen(line) + 1) AS BIGINT) AS total_bytes,
       CASE WHEN SUM(strlen(line) + 1) > 10000000 THEN 4 ELSE 2 END AS writers FROM lines""",
    "stream_ingest": ALL_UPLOADS,
    "stream_ingest_late": ALL_UPLOADS,
}
ORACLES["manifest_inventory"] = ORACLES["landing_inventory"]
ORACLES["manifest_size_profile"] = ORACLES["input_size_profile"]
ORACLES["warehouse_append_once"] = ORACLES["warehouse_append"]
ORACLES["stream_batches"] = ALL_UPLOADS
ORACLES["add_metric"] = ORACLES["upsert_figures"]
