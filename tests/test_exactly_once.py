"""Streams, loads and runs that are repeated, die half way or meet each other."""

import json
import os
import time
from datetime import date
from pathlib import Path

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.loglines import json_lines
from daytally.functions.metrics import DEFAULT_METRICS, RICH_METRICS, Average, Different, figures
from daytally.plans import load
from daytally.plans.ingest import ingest_logs
from daytally.plans.load import DayLoaded, LoadLedger, load_day
from daytally.plans.pipeline import run_day, run_days
from daytally.plans.tables import CalcTables, RunsOverlap
from daytally.session import run_dir
from daytally.sources.files import Files
from daytally.streaming import batches
from daytally.streaming.batches import last_batch, read_batches, stream_batches, untaken_objects

SCHEMA = T.StructType().add("user_id", "string").add("start_time", "timestamp_ntz").add("upload_time", "timestamp_ntz")
PARSER = json_lines(SCHEMA, required=("upload_time",))


def put(root, name, *users):
    path = Path(root) / "logs" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    day = f"{name[:4]}-{name[4:6]}-{name[6:8]}"
    line = '{"user_id":"%s","start_time":"%sT01:00:00","upload_time":"%sT02:00:00"}'
    path.write_text("".join((line % (u, day, day) if u else "broken") + "\n" for u in users))


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("landing", "lake", "checkpoint", "warehouse")}


def users_of(spark, place, kind="good"):
    return sorted(r["user_id"] or "" for r in read_batches(spark, place["lake"], SCHEMA, kind).collect())


def go(spark, place, **options):
    stream_batches(spark, place["landing"], place["lake"], place["checkpoint"], PARSER, **options)


def test_each_batch_is_taken_once(spark, place):
    put(place["landing"], "20240105/a.log", "a", "b", None)
    assert users_of(spark, place) == []
    for _ in range(2):
        go(spark, place)
        assert (users_of(spark, place), users_of(spark, place, "rejects")) == (["a", "b"], [""])
    put(place["landing"], "20240106/b.log", "c")
    put(place["landing"], "20240106/c.log", "d")
    go(spark, place, max_files_per_batch=1)
    assert users_of(spark, place) == ["a", "b", "c", "d"]
    assert not list(Path(place["lake"]).rglob("_spark_metadata"))
    assert [p.name for p in Path(place["lake"]).glob("_*")] == ["_last_batch.json"]


def test_a_batch_that_dies_between_its_write_and_its_note_is_repeated(spark, place, monkeypatch):
    put(place["landing"], "20240105/a.log", "a")
    go(spark, place)
    put(place["landing"], "20240106/b.log", "b", "c")
    monkeypatch.setattr(batches, "_commit", lambda *a: 1 / 0)
    with pytest.raises(PySparkException):
        go(spark, place)
    assert len(list(Path(place["lake"]).glob("batch=*"))) == 2 and users_of(spark, place) == ["a"]
    monkeypatch.undo()
    go(spark, place)
    assert users_of(spark, place) == ["a", "b", "c"]


def test_a_batch_that_dies_after_its_note_is_not_written_again(spark, place, monkeypatch):
    put(place["landing"], "20240105/a.log", "a")
    real = batches._commit
    monkeypatch.setattr(batches, "_commit", lambda *a: (real(*a), 1 / 0))
    with pytest.raises(PySparkException):
        go(spark, place)
    before = {p: p.stat().st_mtime_ns for p in Path(place["lake"]).rglob("*.parquet")}
    monkeypatch.undo()
    go(spark, place)
    assert users_of(spark, place) == ["a"]
    assert {p: p.stat().st_mtime_ns for p in Path(place["lake"]).rglob("*.parquet")} == before


def test_a_lake_belongs_to_one_checkpoint(spark, place):
    put(place["landing"], "20240105/a.log", "a")
    go(spark, place)
    with pytest.raises(ValueError, match="checkpoint"):
        go(spark, place | {"checkpoint": place["checkpoint"] + "2"})
    assert last_batch(spark, place["lake"])["batch"] == 0


def test_files_that_are_passed_over_are_reported(spark, place):
    put(place["landing"], "20240105/a.log", "a")
    go(spark, place, max_file_age="1d")
    put(place["landing"], "20240104/old.log", "b")
    put(place["landing"], "20240104/empty.log")
    then = time.time() - 30 * 86_400
    os.utime(Path(place["landing"]) / "logs/20240104/old.log", (then, then))
    go(spark, place, max_file_age="1d")
    missed = untaken_objects(spark, place["landing"], place["lake"], SCHEMA).collect()
    assert [(r["path"].rpartition("/")[2], r["log_date"]) for r in missed] == [("old.log", date(2024, 1, 4))]


# Loads


@pytest.fixture
def warehouse(spark, place):
    put(place["landing"], "20240105/a.log", "a", "b")
    ingest_logs(spark, place["landing"], place["lake"], PARSER)
    name = "once_" + run_dir(spark, "t").rpartition("-")[2]
    return lambda **o: load_day(spark, place["lake"], name, "2024-01-05", SCHEMA, path=place["warehouse"], **o), name


def test_a_day_is_loaded_once(spark, place, warehouse):
    again, table = warehouse
    assert [again(once=True), again(once=True)] == [True, False]
    assert spark.table(table).count() == 2
    assert rows(spark.table(f"{table}_loads"), "day", "files", "state") == [(date(2024, 1, 5), 1, "begun"), (date(2024, 1, 5), 1, "done")]
    extra = next((Path(place["lake"]) / "kind=good/upload_date=2024-01-05").glob("*.parquet"))
    (extra.parent / f"more-{extra.name}").write_bytes(extra.read_bytes())
    with pytest.raises(DayLoaded, match="other files"):
        again(once=True)


@pytest.mark.parametrize("loaded", [True, False])
def test_a_load_that_did_not_end_is_not_repeated_unseen(spark, place, warehouse, monkeypatch, loaded):
    again, table = warehouse
    real = load.append
    monkeypatch.setattr(load, "append", lambda *a: (real(*a) if loaded else None, 1 / 0))
    with pytest.raises(ZeroDivisionError):
        again(once=True)
    monkeypatch.undo()
    with pytest.raises(DayLoaded, match="did not end"):
        again(once=True)
    LoadLedger(spark, table, place["warehouse"]).settle("2024-01-05", loaded)
    assert again(once=True) is not loaded
    assert spark.table(table).count() == 2


# Runs


def test_of_two_runs_one_raises_before_it_writes(spark, tables, events):
    feed = events(("a", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 1.0))
    lease = Path(tables.location) / "_lease"
    lease.write_text(json.dumps({"owner": "x", "until": time.time() + 60, "run": "another"}))
    with pytest.raises(RunsOverlap, match="another"):
        run_day(tables, feed, "2024-01-01")
    assert spark.table(tables.daily).isEmpty() and tables.latest().isEmpty()
    assert not spark.catalog.tableExists(tables.daily_temp)
    lease.write_text(json.dumps({"owner": "x", "until": time.time() - 1, "run": "dead"}))
    assert run_day(tables, feed, "2024-01-01").count() == 1
    assert not list(Path(tables.location).glob("_lease*"))


def test_a_lease_is_given_back_after_an_error(tables):
    with pytest.raises(ZeroDivisionError), tables.lease():
        1 / 0
    with tables.lease(), tables.lease():
        assert (Path(tables.location) / "_lease").exists()
    assert not (Path(tables.location) / "_lease").exists()


def test_a_lease_is_renewed(tables):
    lease = Path(tables.location) / "_lease"
    until = lambda: json.loads(lease.read_text())["until"]
    with tables.lease(hours=2 / 3600):
        first = until()
        deadline = time.time() + 10
        while time.time() < deadline and not (lease.read_text() and until() > first):
            time.sleep(0.05)
        assert until() > first
    assert not lease.exists()


def test_a_run_that_has_lost_its_lease_writes_no_more(spark, tables, events):
    feed = events(("u", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 1.0))
    lease = Path(tables.location) / "_lease"
    other = json.dumps({"owner": "x", "until": time.time() + 60, "run": "another"})
    with pytest.raises(RunsOverlap, match="taken over"), tables.lease():
        lease.write_text(other)
        run_day(tables, feed, "2024-01-01")
    assert lease.read_text() == other
    assert spark.table(tables.daily).isEmpty() and tables.latest().isEmpty()


def test_a_lease_taken_from_a_dead_run_is_not_taken_again(tables, monkeypatch):
    lease = Path(tables.location) / "_lease"
    lease.write_text(json.dumps({"owner": "x", "until": time.time() - 1, "run": "dead"}))
    other = json.dumps({"owner": "y", "until": time.time() + 60, "run": "another"})
    rename = Files.rename

    def later(self, old, new):
        if old.endswith("_lease"):
            lease.unlink()
            lease.write_text(other)
        return rename(self, old, new)

    monkeypatch.setattr(Files, "rename", later)
    with pytest.raises(RunsOverlap), tables.lease():
        pass
    assert lease.read_text() == other


# Metrics that come later


def test_a_metric_that_comes_later(spark, tables, events):
    feed = events(
        ("a", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 1.0),
        ("a", "2024-01-02 10:00:00", "2024-01-02 12:00:00", 4.0),
        ("b", "2024-01-01 10:00:00", "2024-01-02 12:00:00", None),
        (None, "2024-01-01 10:00:00", "2024-01-02 12:00:00", 5.0),
        ("c", "2024-01-03 10:00:00", "2024-01-03 12:00:00", 7.0),
    ).withColumn("event_type", F.col("user_id"))
    name = run_dir(spark, "tables")
    metrics = (*DEFAULT_METRICS, Average(), Different())
    whole = CalcTables(spark, "calc_" + name.rpartition("-")[2], name, buckets=2, metrics=metrics).create()
    run_days(whole, feed, "2024-01-01", "2024-01-04")
    run_days(tables, feed, "2024-01-01", "2024-01-03")
    grown = tables.add_metric(feed, Average()).add_metric(feed, Different())
    run_day(grown, feed, "2024-01-03")
    assert grown.metrics == metrics and RICH_METRICS[:5] == metrics
    assert rows(figures(grown.latest(), metrics)) == rows(figures(whole.latest(), metrics))
    assert rows(figures(spark.table(grown.daily), metrics)) == rows(figures(spark.table(whole.daily), metrics))
    with pytest.raises(ValueError):
        tables.create()
    run_day(grown, feed, "2024-01-03", replace=False)
    with pytest.raises(ValueError, match="appended"):
        grown.add_metric(feed, Average("other"))
