import uuid

from helpers import plan_of, rows

from daytally import job
from daytally.session import run_dir
from daytally.workload.queries import UPLOAD_SCHEMA
from daytally.workload.views import log_tree, uploads

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "event_id BIGINT, user_id STRING, start_time TIMESTAMP_NTZ, upload_time TIMESTAMP_NTZ, "
    "event_type STRING, value DOUBLE"
)


def call(name, *flags, **options):
    return job.main([name, *[f"--{flag}" for flag in flags], *[text for key, value in options.items() for text in (f"--{key.replace('_', '-')}", value)]])


def test_a_day_from_logs_to_tables(spark, tmp_path):
    root, lake, ds = log_tree(spark, SF), str(tmp_path / "lake"), "2024-01-01"
    calc = {"database": f"job_{uuid.uuid4().hex[:12]}", "location": run_dir(spark, "job"), "buckets": "4"}
    expected = uploads(spark, SF).where("to_date(upload_time) = DATE '2024-01-01'")
    found = call("check", root=root, ds=ds)
    assert found["landed"] and found["writers"] == 2 and found["total_bytes"] > 0
    assert call("ingest", root=root, lake=lake, ds=ds, schema=SCHEMA) == {"good": expected.count(), "rejects": 0}
    table = f"job_{uuid.uuid4().hex[:12]}"
    call("load", lake=lake, table=table, ds=ds, schema=SCHEMA, path=str(tmp_path / "warehouse"))
    assert rows(spark.table(table), *UPLOAD_SCHEMA.names) == rows(expected, *UPLOAD_SCHEMA.names)
    users = expected.select("user_id").distinct().count()
    want = {"users": users, "no_upload_time": 0, "off_day": 0}
    assert call("run", lake=lake, ds=ds, schema=SCHEMA, root=root, **calc) == want
    assert call("run", lake=lake, ds=ds, until="2024-01-02", schema=SCHEMA, **calc) == want
    assert call("rebucket", database=calc["database"], location=calc["location"], buckets="7") == {"buckets": 7}
    assert call("run", "whole-lake", lake=lake, ds=ds, schema=SCHEMA, keep_days="0", **calc) == want


def test_the_daily_run_reads_its_folders_only(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for ds in ("2024-01-01", "2024-01-02", "2024-01-03"):
        call("ingest", "size-rule", root=log_tree(spark, SF), lake=lake, ds=ds, schema=SCHEMA)
    common = ["--lake", lake, "--schema", SCHEMA, "--database", "d", "--location", "l"]
    one = job.events_of(spark, job.parse_args(["run", "--ds", "2024-01-02", *common]))
    assert all("2024-01-02" in f for f in one.inputFiles())
    two = job.events_of(spark, job.parse_args(["run", "--ds", "20240102", "--until", "2024-01-04", *common]))
    assert not any("2024-01-01" in f for f in two.inputFiles()) and two.count() > one.count()
    assert "PushedFilters: [" in plan_of(one.where("upload_time > TIMESTAMP_NTZ '2024-01-02 00:00:00'"))


def test_the_first_load_and_the_stream(spark, tmp_path):
    root, lake = log_tree(spark, SF), str(tmp_path / "lake")
    call("stream", root=root, lake=lake, checkpoint=str(tmp_path / "c"), schema=SCHEMA)
    assert spark.read.parquet(lake).where("kind = 'good'").count() == 1_000
    table = f"job_{uuid.uuid4().hex[:12]}"
    call("load", "all", lake=lake, table=table, schema=SCHEMA, path=str(tmp_path / "warehouse"), partitions="3")
    assert rows(spark.table(table), *UPLOAD_SCHEMA.names) == rows(uploads(spark, SF), *UPLOAD_SCHEMA.names)


def test_any_prefix_can_be_checked(spark, tmp_path):
    (tmp_path / "some").mkdir()
    (tmp_path / "some" / "file.txt").write_text("12345")
    found = call("check", prefix=f"{tmp_path}/so", suffix=".txt")
    assert found == {"landed": True, "n_objects": 1, "total_bytes": 5, "writers": 2}


def test_a_day_that_has_not_landed(spark, tmp_path):
    root, lake = str(tmp_path / "none"), str(tmp_path / "lake")
    assert call("check", root=root, ds="2024-01-01") == {"landed": False, "total_bytes": 0, "writers": 2}
    assert call("ingest", root=root, lake=lake, ds="2024-01-01", schema=SCHEMA) == {}


def test_deltas_corrections_and_loads_by_command(spark, tmp_path):
    root, lake, days = log_tree(spark, SF), str(tmp_path / "lake"), ("2024-01-01", "2024-01-02")
    calc = {"lake": lake, "schema": SCHEMA, "database": f"job_{uuid.uuid4().hex[:12]}", "location": run_dir(spark, "job"), "buckets": "2"}
    table = {"table": f"job_{uuid.uuid4().hex[:12]}"}
    for ds in days:
        call("ingest", root=root, lake=lake, ds=ds, schema=SCHEMA)
        assert call("load", "once", lake=lake, ds=ds, schema=SCHEMA, path=str(tmp_path / "w"), **table) == {"loaded": ds}
        users = call("run", "deltas", ds=ds, compact_after="1", **calc)["users"]
    assert call("load", "once", lake=lake, ds=days[0], schema=SCHEMA, path=str(tmp_path / "w"), **table) == {"loaded": "nothing"}
    assert call("recluster", **table)["replaced"] >= 0
    assert call("correct", ds=days[0], **calc) == {"users": users, "changed": 0}
    assert call("strays", root=root) == {"objects": 0, "bytes": 0, "first": []}
