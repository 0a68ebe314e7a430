"""The event feed of the workload: upload times, dirty user ids and a log tree, derived from the ``events`` table."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.dates import as_day, ntz
from daytally.functions.loglines import to_json_line
from daytally.session import run_dir
from daytally.sources.landing import LOG_FOLDER

UPLOAD_SCHEMA = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("user_id", T.StringType())
    .add("start_time", T.TimestampNTZType())
    .add("upload_time", T.TimestampNTZType())
    .add("event_type", T.StringType())
    .add("value", T.DoubleType())
)

# A row is uploaded 0 to 47 hours after it starts, or on the midnight after.
MAX_LAG = timedelta(hours=48)


def uploads(
    spark: SparkSession,
    sf_dir: str,
    start: str | date | None = None,
    end: str | date | None = None,
    dirty: bool = False,
) -> DataFrame:
    """All uploads, laid out as the source event table.

    ``start`` and ``end`` tell which upload days the caller will ask for. They add the bounds these put on ``ts``, the
    one column the files can be pruned by; the caller still filters on ``upload_time``.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if start:
        events = events.where(F.col("ts") > ntz(datetime.combine(as_day(start), datetime.min.time()) - MAX_LAG))
    if end:
        events = events.where(F.col("ts") <= ntz(as_day(end)))
    lag = F.make_dt_interval(F.lit(0), (F.col("event_id") % 48).cast("int"))
    midnight = F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz")
    return events.select(
        "event_id",
        _dirty_id() if dirty else F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_id") % 97 == 0, midnight).otherwise(F.col("ts") + lag).alias("upload_time"),
        "event_type",
        "value",
    )


def _dirty_id() -> Column:
    clean = F.col("user_id").cast("string")
    return (
        F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 103 == 0, F.lpad(clean, 21, "0"))
        .otherwise(clean)
        .alias("user_id")
    )


def log_lines(spark: SparkSession, sf_dir: str, garbage: bool = False) -> DataFrame:
    """Every upload as a JSON line with its upload date; with ``garbage`` some lines are no JSON."""
    rows = uploads(spark, sf_dir)
    line = to_json_line(*rows.columns)
    if garbage:
        line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("garbage "), F.col("event_id"))).otherwise(line)
    return rows.select(line.alias("line"), F.date_format("upload_time", "yyyyMMdd").alias("folder"))


_trees: dict[tuple[str, str, bool], str] = {}


def log_tree(spark: SparkSession, sf_dir: str, garbage: bool = False) -> str:
    """Root of ``logs/<yyyymmdd>/*.log`` with all lines; written once per session and shared by the queries."""
    key = (spark.sparkContext.applicationId, sf_dir, garbage)
    if key not in _trees:
        root = run_dir(spark, "landing")
        write_log_tree(log_lines(spark, sf_dir, garbage), root)
        _trees[key] = root
    return _trees[key]


def write_log_tree(lines: DataFrame, root: str, age: timedelta | None = None) -> None:
    """Writes ``line`` into ``.log`` files, below folders named by ``folder``; with ``age`` as if so long ago.

    The text writer cannot name its files ``.log``; the CSV writer can, and with one column and neither separator nor
    quote in the text it writes the lines as they are. The ``folder=`` that the writer puts before each folder's name
    is taken off afterwards.
    """
    spark = lines.sparkSession
    tree, staged = f"{root}/{LOG_FOLDER}", f"{root}-{uuid.uuid4().hex}"
    (
        lines.write.partitionBy("folder")
        .options(extension="log", sep="\u0001", quote="\u0000", escape="\u0000", compression="none")
        .csv(staged)
    )
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(tree)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(base)
    for status in files.listStatus(jvm.org.apache.hadoop.fs.Path(staged)):
        name = status.getPath().getName()
        if name.startswith("folder="):
            if age:
                then = int((datetime.now() - age).timestamp() * 1000)
                for log in files.listStatus(status.getPath()):
                    files.setTimes(log.getPath(), then, -1)
            target = jvm.org.apache.hadoop.fs.Path(base, name.removeprefix("folder="))
            if not files.rename(status.getPath(), target):
                raise RuntimeError(f"could not rename {name} below {tree}")
