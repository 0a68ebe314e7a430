import os
import time
from datetime import date, timedelta
from pathlib import Path

import pytest
from helpers import plan_of, exchanges, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.loglines import LineParser, json_lines
from daytally.plans.ingest import ingest_day, ingest_logs, writers_for
from daytally.plans import load
from daytally.plans.load import clustered, job_days, load_day, load_lake, plan_days
from daytally.session import run_dir, shared_dir
from daytally.sources.lake import misplaced, read_events, read_rejects
from daytally.sources.landing import (
    SizeRule,
    input_size_profile,
    landing_gate,
    landing_inventory,
    landing_status,
    list_objects,
    log_objects,
    object_totals,
    prefix_gate,
    size_profile,
    stray_objects,
)
from daytally.sources.logs import log_glob, month_glob, route, scan_lines
from daytally.streaming.ingest import stream_ingest
from daytally.workload.queries import PARSER, UPLOAD_SCHEMA
from daytally.workload.views import log_lines, log_tree, uploads

SF = "/root/testdata/sf0.001"
SMALL = T.StructType().add("user_id", "string").add("start_time", "timestamp_ntz").add("value", "double")
SMALL_PARSER = json_lines(SMALL)


def line(user, hour=1, value=1.5):
    return f'{{"user_id":"{user}","start_time":"2024-01-05T{hour:02d}:00:00.000001","value":{value}}}'


def put(root, name, *lines):
    path = Path(root) / "logs" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{one}\n" for one in lines))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


# Landing


def test_listing_is_by_string_prefix_and_suffix(spark, root):
    put(root, "20240105/a.log", "1")
    put(root, "20240105x/deep/b.log", "22")
    put(root, "20240105/c.txt", "333")
    put(root, "20240106/d.log", "4444")
    names = lambda df: sorted(Path(r["path"]).name for r in df.collect())
    assert names(list_objects(spark, f"{root}/logs/20240105", ".log")) == ["a.log", "b.log"]
    assert names(list_objects(spark, f"{root}/logs/")) == ["a.log", "b.log", "c.txt", "d.log"]
    assert names(list_objects(spark, f"{root}/nothing", ".log")) == []


def test_gate(spark, root):
    put(root, "20240105/a.log", "1")
    put(root, "20240106/a.txt", "1")
    assert landing_gate(spark, root, "2024-01-05")
    assert not landing_gate(spark, root, "2024-01-06")
    assert not landing_gate(spark, root, "2024-01-07")


def test_inventory_counts_objects_and_bytes(spark, root):
    put(root, "20240105/a.log", "1")
    put(root, "20240105x/deep/b.log", "22")
    put(root, "20240106/c.log", "4444")
    put(root, "20240105/e.log", "1")
    assert rows(landing_inventory(spark, root)) == [(date(2024, 1, 5), 2, 4), (date(2024, 1, 6), 1, 5)]
    wanted = [date(2024, 1, 4), date(2024, 1, 6)]
    assert rows(landing_inventory(spark, root, wanted), "log_date") == [(date(2024, 1, 6),)]
    assert rows(landing_inventory(spark, root, wanted[:1]), "log_date") == []
    assert rows(landing_status(spark, root, "2024-01-04", "2024-01-06")) == [
        (date(2024, 1, 4), False),
        (date(2024, 1, 5), True),
    ]


def test_listing_reads_no_contents(spark, root):
    put(root, "20240105/a.log", "1")
    plan = plan_of(log_objects(spark, root, [date(2024, 1, 5)]))
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


@pytest.mark.parametrize("size,writers", [(0, 2), (10_000_000, 2), (10_000_001, 4)])
def test_size_rule_is_strict(spark, size, writers):
    listing = spark.createDataFrame([(size,)] if size else [], "length bigint")
    assert rows(input_size_profile(listing)) == [(size, writers)]


def test_size_rule_over_the_tables(spark):
    for sf, writers in (("0.001", 2), ("0.01", 2), ("0.1", 4)):
        assert input_size_profile(list_objects(spark, f"/root/testdata/sf{sf}/")).first()["writers"] == writers


def test_hidden_names_count_in_totals(spark, root):
    put(root, "20240105/a.log", "1234567890")
    put(root, "20240105/_SUCCESS", "x" * 100)
    put(root, "20240105/.part.log", "y" * 10)
    assert object_totals(spark, f"{root}/logs/20240105/") == (3, 11 + 101 + 11)
    assert object_totals(spark, f"{root}/") == object_totals(spark, root)
    assert object_totals(spark, f"{root}/nothing") == (0, 0)
    assert rows(size_profile(spark, f"{root}/", SizeRule(threshold=100))) == [(3, 123, 4)]
    assert input_size_profile(list_objects(spark, f"{root}/logs/")).first()["total_bytes"] == 11


def test_a_gate_over_any_prefix(spark, root):
    put(root, "20240105/a.log", "1")
    assert prefix_gate(spark, f"{root}/lo") and prefix_gate(spark, f"{root}/logs/2024", ".log")
    assert not prefix_gate(spark, f"{root}/lx") and not prefix_gate(spark, f"{root}/logs/", ".txt")


def test_all_jobs_go_by_one_rule_for_folders(spark, root, lake, tmp_path):
    put(root, "20240105/a.log", line("a"))
    for stray in ("20240105x/b.log", "junk/c.log", "20240106x/d.log", "20240105/deep/e.log", "20241399/f.log", "20240105/g.txt"):
        put(root, stray, line(stray))
    assert not landing_gate(spark, root, "2024-01-06") and landing_gate(spark, root, date(2024, 1, 5))
    assert rows(landing_inventory(spark, root), "log_date", "n_objects") == [(date(2024, 1, 5), 1)]
    assert rows(log_objects(spark, root, [])) == []
    strays = [Path(r["path"]).name for r in stray_objects(spark, root).collect()]
    assert sorted(strays) == ["b.log", "c.log", "d.log", "e.log", "f.log", "g.txt"]
    want = [("a", date(2024, 1, 5))]
    ingest_logs(spark, root, lake, SMALL_PARSER)
    assert rows(read_events(spark, lake, SMALL), "user_id", "upload_date") == want
    assert ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER) == {"good": 1, "rejects": 0}
    assert ingest_day(spark, root, lake, "2024-01-06", SMALL_PARSER) is None
    assert rows(read_events(spark, lake, SMALL), "user_id", "upload_date") == want
    stream_ingest(spark, root, str(tmp_path / "s"), str(tmp_path / "c"), SMALL_PARSER)
    assert rows(spark.read.parquet(str(tmp_path / "s")), "user_id", "upload_date") == want


def test_a_day_may_be_written_in_either_form(spark, root, lake):
    put(root, "20240105/a.log", line("a"), "broken")
    ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER)
    put(root, "20240105/a.log", line("a"))
    assert ingest_day(spark, root, lake, "20240105", SMALL_PARSER) == {"good": 1, "rejects": 0}
    assert read_rejects(spark, lake).isEmpty()
    assert [p.name for p in Path(lake, "kind=rejects").iterdir() if p.is_dir()] == ["upload_date=2024-01-05"]


# Parsing


@pytest.mark.parametrize(
    "text,good",
    [
        (line("a"), True),
        (line("a") + "   ", True),
        ('{"user_id":"a","extra":{"n":[1,2]},"value":1}', True),
        ('{"user_id":"}{","value":1}', True),
        ("{}", True),
        ("garbage 5", False),
        ("", False),
        ("   ", False),
        ("null", False),
        ("[]", False),
        (f"[{line('a')}]", False),
        ('{"user_id":"a"', False),
        ('{"user_id":"a","value":"much"}', False),
        ('{"user_id":"a","start_time":"not a time"}', False),
        (line("a", value="NaN"), False),
        (line("a", value='"NaN"'), False),
        (line("a", value='"Infinity"'), False),
        (line("a", value="-Infinity"), False),
        (line("a") + " trailing", False),
        (line("a") + line("b"), False),
        (line("a") + ", " + line("b"), False),
    ],
)
def test_a_line_is_one_whole_object_or_a_reject(spark, text, good):
    lines = spark.createDataFrame([(text, date(2024, 1, 5))], "line string, upload_date date")
    found = route(lines, SMALL_PARSER).first()
    assert found["kind"] == ("good" if good else "rejects")
    assert found["line"] == (None if good else text)


def test_required_fields(spark):
    lines = spark.createDataFrame([("{}",), (line("a"),), ('{"user_id":null,"value":1}',)], "line string")
    parser = json_lines(SMALL, required=("user_id",))
    found = route(lines.withColumn("upload_date", F.lit(None).cast("date")), parser)
    assert rows(found, "kind") == [("good",), ("rejects",), ("rejects",)]


def test_another_line_format(spark, root, lake):
    def parse(text):
        parts = F.split(text, "\\|")
        return F.struct(
            F.get(parts, 0).alias("user_id"),
            F.get(parts, 1).try_cast("timestamp_ntz").alias("start_time"),
            F.get(parts, 2).try_cast("double").alias("value"),
            F.size(parts).alias("n"),
        )

    def failed(record, text):
        return (record["n"] != 3) | record["start_time"].isNull() | record["value"].isNull()

    put(root, "20240105/a.log", "a|2024-01-05 01:00:00|1.5", "a|noon|1.5", "a|2024-01-05 01:00:00")
    ingest_logs(spark, root, lake, LineParser(SMALL, parse, failed))
    assert rows(read_events(spark, lake, SMALL), "user_id", "value") == [("a", 1.5)]
    assert rows(read_rejects(spark, lake), "line") == [("a|2024-01-05 01:00:00",), ("a|noon|1.5",)]


def test_each_line_is_parsed_once(spark, root):
    put(root, "20240105/a.log", line("a"))
    plan = plan_of(route(scan_lines(spark, log_glob(root)), SMALL_PARSER))
    assert plan.count("from_json") == 1


def test_the_log_tree_holds_the_lines_byte_for_byte(spark):
    root = log_tree(spark, SF, garbage=True)
    want = log_lines(spark, SF, garbage=True)
    got = spark.read.text(log_glob(root)).select(F.col("value").alias("line"))
    assert got.count() == want.count()
    assert got.exceptAll(want.select("line")).isEmpty()


# Ingest


def test_good_and_rejects_add_up(spark, lake):
    ingest_logs(spark, log_tree(spark, SF, garbage=True), lake, PARSER)
    good, rejects = read_events(spark, lake, UPLOAD_SCHEMA), read_rejects(spark, lake)
    assert good.count() + rejects.count() == 1_000
    assert rejects.count() == 20
    assert good.where("event_id IS NULL").isEmpty()


def test_ingest_shuffles_nothing(spark, root):
    put(root, "20240105/a.log", line("a"))
    assert "Exchange" not in plan_of(route(scan_lines(spark, log_glob(root)), SMALL_PARSER))


def test_a_day_is_replaced_and_others_stay(spark, root, lake):
    put(root, "20240105/a.log", line("a"), "broken", line("b"))
    put(root, "20240106/a.log", line("c"), "bad")
    assert ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER) == {"good": 2, "rejects": 1}
    assert ingest_day(spark, root, lake, "2024-01-06", SMALL_PARSER) == {"good": 1, "rejects": 1}
    assert ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER) == {"good": 2, "rejects": 1}
    assert rows(read_events(spark, lake, SMALL), "user_id") == [("a",), ("b",), ("c",)]
    assert rows(read_rejects(spark, lake), "line") == [("bad",), ("broken",)]


def test_a_corrected_day_leaves_no_old_rejects_or_rows(spark, root, lake):
    put(root, "20240105/a.log", line("a"), "broken")
    ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER)
    put(root, "20240105/a.log", line("a"))
    assert ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER) == {"good": 1, "rejects": 0}
    assert read_rejects(spark, lake).isEmpty()
    put(root, "20240105/a.log", "all broken")
    ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER)
    assert read_events(spark, lake, SMALL, "2024-01-05").isEmpty()
    assert rows(read_rejects(spark, lake, "2024-01-05"), "line") == [("all broken",)]


def test_the_first_load_refuses_a_lake_that_exists(spark, root, lake):
    put(root, "20240105/a.log", line("a"))
    ingest_logs(spark, root, lake, SMALL_PARSER)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        ingest_logs(spark, root, lake, SMALL_PARSER)
    assert read_events(spark, lake, SMALL).count() == 1


def test_rejects_keep_the_line_and_no_fields(spark, root):
    put(root, "20240105/a.log", line("a") + line("b"))
    found = route(scan_lines(spark, log_glob(root)), SMALL_PARSER).first()
    assert (found["user_id"], found["value"], found["line"]) == (None, None, line("a") + line("b"))


def test_a_day_without_logs_writes_nothing(spark, root, lake):
    put(root, "20240105/a.txt", line("a"))
    put(root, "20240105x/a.log", line("a"))
    assert ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER) is None
    assert not Path(lake).exists()
    assert read_events(spark, lake, SMALL, "2024-01-05").isEmpty()


def test_the_size_rule_limits_files(spark, root, lake):
    for n in range(40):
        put(root, f"20240105/{n}.log", *[line(f"u{n}-{i}") for i in range(20)])
    assert writers_for(spark, root, "2024-01-05", SizeRule()) == 2
    assert writers_for(spark, root, "2024-01-05", SizeRule(threshold=100)) == 4
    total = object_totals(spark, f"{root}/logs/20240105/")[1]
    assert writers_for(spark, root, "2024-01-05", SizeRule(bytes_per_writer=total // 7 - 1)) == 8
    assert SizeRule(bytes_per_writer=total // 7 - 1).writers(total) == 8
    ingest_day(spark, root, lake, "2024-01-05", SMALL_PARSER, SizeRule())
    assert len(read_events(spark, lake, SMALL, "2024-01-05").inputFiles()) <= 2
    assert read_events(spark, lake, SMALL).count() == 800


def test_a_day_is_read_from_its_own_folder(spark, root, lake):
    for day in ("20240105", "20240106"):
        put(root, f"{day}/a.log", line(day))
    ingest_logs(spark, root, lake, SMALL_PARSER)
    day = read_events(spark, lake, SMALL, "2024-01-05")
    assert all("upload_date=2024-01-05" in f for f in day.inputFiles())
    assert rows(day, "user_id", "upload_date") == [("20240105", date(2024, 1, 5))]


def test_a_range_of_days_lists_their_folders_only(spark, root, lake):
    for day in ("20240104", "20240105", "20240107", "20240108"):
        put(root, f"{day}/a.log", line(day))
    ingest_logs(spark, root, lake, SMALL_PARSER)
    found = read_events(spark, lake, SMALL, "2024-01-05", "2024-01-08")
    assert rows(found, "user_id") == [("20240105",), ("20240107",)]
    assert not any("2024-01-04" in f or "2024-01-08" in f for f in found.inputFiles())
    assert read_events(spark, lake, SMALL, "2024-01-05", "2024-01-05").isEmpty()
    assert read_events(spark, lake, SMALL, "2025-01-05", "2025-01-08").isEmpty()


def test_misplaced_rows_are_counted(spark):
    events = spark.sql(
        """SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-05 01:00:00', DATE '2024-01-05'),
        (TIMESTAMP_NTZ '2024-01-06 00:00:00', DATE '2024-01-05'), (NULL, DATE '2024-01-05') t(upload_time, upload_date)"""
    )
    assert rows(misplaced(events)) == [(1, 1)]


# Warehouse load


def test_load_appends_and_makes_day_partitions(spark, root, lake, tmp_path):
    put(root, "20240105/a.log", line("a"), line("b").replace("01-05", "01-04"))
    ingest_logs(spark, root, lake, SMALL_PARSER)
    path = str(tmp_path / "warehouse")
    table = "load_" + run_dir(spark, "t").rpartition("-")[2]
    for _ in range(2):
        load_day(spark, lake, table, "2024-01-05", SMALL, path=path)
    assert spark.table(table).count() == 4
    assert sorted(p.name for p in Path(path).glob("event_day=*")) == ["event_day=2024-01-04", "event_day=2024-01-05"]


def test_clustering_splits_a_hot_value_and_keeps_order(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.range(0, 30_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS user_id",
        "TIMESTAMP_NTZ '2024-01-05 01:00:00' AS start_time",
    ).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = clustered(spark.read.parquet(path), "start_time", ("user_id",), 8)
        parts = ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
        found = [(r["part"], r["user_id"]) for r in parts.orderBy("at").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [user for _, user in found] == sorted(user for _, user in found)
    hot = [part for part, user in found if user == "hot"]
    assert len(hot) == 10_000 and len(set(hot)) > 1
    assert max(hot.count(part) for part in set(hot)) < 7_000
    assert len({part for part, _ in found}) == 8


def test_load_shuffles_once(spark, root, lake):
    put(root, "20240105/a.log", line("a"))
    ingest_logs(spark, root, lake, SMALL_PARSER)
    rows_of = read_events(spark, lake, SMALL, "2024-01-05")
    day = clustered(rows_of, "start_time", ("user_id",), 4)
    assert "REPARTITION_BY_NUM" not in plan_of(day)  # a single row needs no cut
    put(root, "20240106/b.log", *[line(f"u{i}").replace("01-05", "01-06") for i in range(40)])
    ingest_day(spark, root, lake, "2024-01-06", SMALL_PARSER)
    rows_of = read_events(spark, lake, SMALL, "2024-01-06")
    plan = plan_of(clustered(rows_of, "start_time", ("user_id",), 4))
    assert plan.count("REPARTITION_BY_NUM") == 1
    # The bounds come from the key columns alone.
    assert "ReadSchema: struct<user_id:string,start_time:timestamp_ntz,_tmp_metadata_row_index:bigint>" in plan
    assert exchanges(clustered(rows_of, "start_time", ("user_id",), 1)) == []


def test_no_row_of_a_load_holds_more_keys_than_its_day_may(monkeypatch):
    """However many days and rows: a hundred keys per partition of a day, up to a bound; a bound per partition."""
    first = date(2024, 1, 1)
    many = [(first + timedelta(days=i), 1_000_000 + i) for i in range(900)]
    plans = plan_days([*many, (first + timedelta(days=900), 10**12), (None, 5)], 8_000)
    assert all(p.sampled * p.rows <= 100 * p.partitions + 1 and p.sampled * p.rows <= load.SAMPLED_PER_DAY + 1 for p in plans)
    assert max(p.first + p.partitions for p in plans) <= 8_000 + len(plans)
    places = [(p.first, p.first + p.partitions - 1) for p in plans]
    assert places == sorted(places) and all(a[1] <= b[0] for a, b in zip(places, places[1:]))
    sizes = {day: 100 << 30 for day, _ in many}
    monkeypatch.setattr(load, "PARTITIONS_PER_JOB", 1_000)
    jobs = job_days(sizes, 80_000)
    assert [d for days_of in jobs for d in days_of] == sorted(sizes) and all(len(days_of) * 80_000 / 900 <= 1_000 for days_of in jobs)


@pytest.mark.parametrize("per_job", [1, 3, 10_000])
def test_a_lake_is_loaded_in_as_many_jobs_as_it_takes(spark, root, lake, tmp_path, monkeypatch, per_job):
    for d in (4, 5, 6):
        put(root, f"2024010{d}/a.log", *[line(f"u{i % 7}").replace("01-05", f"01-0{d}") for i in range(30)])
    ingest_logs(spark, root, lake, SMALL_PARSER)
    monkeypatch.setattr(load, "PARTITIONS_PER_JOB", per_job)
    table = "load_" + run_dir(spark, "t").rpartition("-")[2]
    load_lake(spark, lake, table, SMALL, path=str(tmp_path / "warehouse"), partitions=4)
    assert rows(spark.table(table).groupBy("event_day").count()) == [(date(2024, 1, d), 30) for d in (4, 5, 6)]


def test_rows_without_an_event_time_are_loaded(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(200).selectExpr(
        "CAST(id AS STRING) AS user_id", "IF(id % 5 = 0, NULL, TIMESTAMP_NTZ '2024-01-05 00:00:00') AS start_time"
    ).write.parquet(path)
    got = clustered(spark.read.parquet(path), "start_time", ("user_id",), 6)
    assert got.columns == ["user_id", "start_time", "event_day"]
    assert sorted(int(r[0]) for r in got.select("user_id").collect()) == list(range(200))


@pytest.mark.parametrize("partitions", [2, 3, 7, 16])
def test_clustering_places_every_row(spark, tmp_path, partitions):
    path = str(tmp_path / "rows")
    spark.range(0, 3_000, 1, 3).selectExpr(
        "IF(id % 11 = 0, NULL, CAST(id % 97 AS STRING)) AS user_id",
        "TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_dt_interval(CAST(id % 3 AS INT)) AS start_time",
        "id AS value",
    ).write.parquet(path)
    ordered = clustered(spark.read.parquet(path), "start_time", ("user_id",), partitions)
    found = [tuple(r) for r in ordered.withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()]
    key = lambda r: (r[1].date(), r[0] is not None, r[0] or "")
    assert [key(r) for r in found] == sorted(map(key, found))
    assert sorted(r[2] for r in found) == list(range(3_000))


# Stream


def test_each_run_takes_only_new_files(spark, root, tmp_path):
    lake, checkpoint = str(tmp_path / "stream"), str(tmp_path / "checkpoint")
    put(root, "20240105/a.log", line("a"), "broken")
    counts = []
    for step in range(4):
        if step == 2:
            put(root, "20240105/late.log", line("b"))
            put(root, "20240106/c.log", line("c"))
        stream_ingest(spark, root, lake, checkpoint, SMALL_PARSER, max_files_per_batch=1)
        counts.append(spark.read.parquet(lake).count())
    assert counts == [2, 2, 4, 4]
    found = spark.read.parquet(lake)
    assert rows(found.where("kind = 'good'"), "user_id", "upload_date") == [
        ("a", date(2024, 1, 5)),
        ("b", date(2024, 1, 5)),
        ("c", date(2024, 1, 6)),
    ]
    assert rows(found.where("kind = 'rejects'"), "line") == [("broken",)]


def test_late_files_with_old_times_are_taken(spark, root, tmp_path):
    lake, checkpoint = str(tmp_path / "stream"), str(tmp_path / "checkpoint")
    put(root, "20240105/a.log", line("a"))
    stream_ingest(spark, root, lake, checkpoint, SMALL_PARSER)
    put(root, "20240104/b.log", line("b"))
    put(root, "20240104/c.log", line("c"))
    then = time.time() - 30 * 86_400
    os.utime(Path(root) / "logs/20240104/b.log", (then, then))
    for _ in range(2):
        stream_ingest(spark, root, lake, checkpoint, SMALL_PARSER)
    assert rows(spark.read.parquet(lake), "user_id") == [("a",), ("b",), ("c",)]


def test_a_stream_over_one_month(spark, root, tmp_path):
    put(root, "20240105/a.log", line("a"))
    put(root, "20240205/b.log", line("b"))
    glob = month_glob(root, 2024, 2)
    stream_ingest(spark, root, str(tmp_path / "s"), str(tmp_path / "c"), SMALL_PARSER, glob=glob)
    assert rows(spark.read.parquet(str(tmp_path / "s")), "user_id") == [("b",)]


def test_stream_and_batch_agree(spark, lake, tmp_path):
    root = log_tree(spark, SF, garbage=True)
    ingest_logs(spark, root, lake, PARSER)
    stream_ingest(spark, root, str(tmp_path / "s"), str(tmp_path / "c"), PARSER)
    streamed = spark.read.parquet(str(tmp_path / "s")).where("kind = 'good'").drop("kind", "line")
    assert rows(streamed, *UPLOAD_SCHEMA.names) == rows(read_events(spark, lake, UPLOAD_SCHEMA), *UPLOAD_SCHEMA.names)
    assert rows(streamed, *UPLOAD_SCHEMA.names) == rows(
        uploads(spark, SF).where("event_id % 50 <> 0"), *UPLOAD_SCHEMA.names
    )


# Shared folder


def test_scratch_goes_to_the_folder_the_session_names(spark):
    assert run_dir(spark, "x") != run_dir(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert run_dir(spark, "x").startswith(f"{shared_dir(spark)}/daytally-x-")
