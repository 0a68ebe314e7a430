"""A larger trial than the given tables allow: the daily steps over made-up events. Prints one JSON line.

TRIAL_MILLIONS: millions of events per day (default 4), TRIAL_DAYS: days (default 3), TRIAL_CPUS: local cores (default 8).
A third of all rows belongs to one user. The events are written below the shared folder first, and left there.
"""

from __future__ import annotations

import json
import os
import time
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.dates import run_time
from daytally.operators.daily import daily_calc
from daytally.plans.pipeline import backfill
from daytally.plans.tables import CalcTables
from daytally.session import local_session, run_dir

FIRST = date(2024, 1, 1)


def events(spark: SparkSession, rows: int, days: int) -> DataFrame:
    path = run_dir(spark, "trial")
    number = F.col("id") % F.lit(rows)
    upload = F.lit(str(FIRST)).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") / rows).cast("int"), F.lit(1))
    (
        spark.range(rows * days)
        .select(
            F.when(number % 3 == 0, F.lit("hot")).otherwise((F.xxhash64("id") % (rows // 2)).cast("string")).alias("user_id"),
            (upload - F.make_dt_interval((F.col("id") % 3).cast("int"))).alias("start_time"),
            upload.alias("upload_time"),
            ((F.col("id") % 10_000) / 100).alias("value"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def timed(found: dict, name: str, step):
    begin = time.perf_counter()
    out = step()
    found[name] = round(time.perf_counter() - begin, 2)
    return out


def main() -> None:
    rows, days = int(float(os.environ.get("TRIAL_MILLIONS", "4")) * 1e6), int(os.environ.get("TRIAL_DAYS", "3"))
    cores = int(os.environ.get("TRIAL_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=2 * cores)
    feed = events(spark, rows, days)
    tables = CalcTables(spark, "trial", run_dir(spark, "trial-tables"), buckets=2 * cores).create()
    found: dict[str, float] = {}
    last = FIRST + timedelta(days=days)
    for n in range(days):
        day = FIRST + timedelta(days=n)
        daily = daily_calc(feed, day)
        timed(found, f"daily_calc {n + 1}", lambda d=daily: d.write.format("noop").mode("overwrite").save())
        staged = timed(found, f"stage_daily {n + 1}", lambda d=daily: tables.stage_daily(d))
        timed(found, f"append_daily {n + 1}", lambda s=staged, d=day: tables.append_daily(s, [d]))
        users = timed(found, f"upsert {n + 1}", lambda s=staged, d=day: tables.upsert(s, d, d, run_time(d)))
    again = CalcTables(spark, "trial_backfill", run_dir(spark, "trial-tables"), buckets=2 * cores).create()
    whole = timed(found, "backfill", lambda: backfill(again, feed, FIRST, last))
    same = users.select("user_id", "event_count", "total_value").exceptAll(whole.select("user_id", "event_count", "total_value"))
    print(json.dumps({"rows_per_day": rows, "days": days, "users": users.count(), "same": same.isEmpty(), "sec": found}))


if __name__ == "__main__":
    main()
