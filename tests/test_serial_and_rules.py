from helpers import rows
from pyspark.sql import functions as F

from daytally.functions.rules import daily_rules, user_rules
from daytally.operators.quality import constraint_violations, duplicate_keys, split_rows
from daytally.operators.serial import assign_ids, with_positions
from daytally.workload.views import uploads

SF = "/root/testdata/sf0.01"


def numbered(spark, path, source, *order, start_after=0):
    with_positions(source, *order).write.parquet(path)
    return assign_ids(spark.read.parquet(path), start_after)


def test_ids_follow_the_key_order_without_gaps(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        source = spark.range(10_000).select(F.xxhash64("id").alias("key"))
        result = numbered(spark, str(tmp_path / "n"), source, "key", start_after=41)
        files = spark.read.parquet(str(tmp_path / "n")).select(F.input_file_name()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files > 1
    pairs = sorted((r["id"], r["key"]) for r in result.collect())
    assert [i for i, _ in pairs] == list(range(42, 10_042))
    assert [k for _, k in pairs] == sorted(k for _, k in pairs)


def test_rows_filtered_off_the_end_leave_no_gap(spark, tmp_path):
    source = spark.range(1_000).selectExpr("id AS key", "id % 10 = 0 AS rejected")
    with_positions(source, "rejected", "key").write.parquet(str(tmp_path / "r"))
    good = spark.read.parquet(str(tmp_path / "r")).where("NOT rejected")
    assert sorted(r["id"] for r in assign_ids(good).collect()) == list(range(1, 901))


def test_equal_keys_get_different_ids(spark, tmp_path):
    result = numbered(spark, str(tmp_path / "e"), spark.range(3_000).selectExpr("'same' AS key"), "key")
    assert result.select("id").distinct().count() == 3_000


def test_split_keeps_every_row(spark):
    feed = uploads(spark, SF, dirty=True)
    good, rejects = split_rows(feed, user_rules())
    assert good.count() + rejects.count() == feed.count()
    assert good.where("user_id IS NULL OR length(user_id) > 20").isEmpty()


def test_rules_name_the_first_breach(spark):
    frame = spark.createDataFrame(
        [(None, "2024-01-01"), ("u" * 21, "2024-01-01"), ("u" * 20, "2024-01-01"), ("u", None), (None, None)],
        "user_id string, event_date string",
    ).withColumn("upload_date", F.col("event_date"))
    assert rows(constraint_violations(frame, daily_rules())) == [
        ("event_date is null", 1),
        ("user_id is null", 2),
        ("user_id longer than 20", 1),
    ]


def test_length_counts_characters(spark):
    frame = spark.createDataFrame([("é" * 20,), ("é" * 21,)], "user_id string")
    assert rows(constraint_violations(frame, user_rules())) == [("user_id longer than 20", 1)]


def test_duplicate_keys(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "user_id string")
    assert rows(duplicate_keys(frame, "user_id")) == [("a", 2)]
