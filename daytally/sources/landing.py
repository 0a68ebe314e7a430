"""What has landed: object listings, the log check of a day, and the size rule."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.dates import as_day, days, nodash

# Folder and suffix of the log objects, and the size rule.
LOG_FOLDER = "logs"
LOG_SUFFIX = ".log"
# Every reader of logs goes by this: the folder's whole name is the date, and the object lies directly in it.
DAY_DIGITS = 8
SIZE_THRESHOLD = 10_000_000
ABOVE_THRESHOLD = 4
UP_TO_THRESHOLD = 2


def list_objects(spark: SparkSession, prefix: str, suffix: str | None = None, tasks: int = 1_000) -> DataFrame:
    """Path and length of every object whose path starts with ``prefix`` and ends with ``suffix``.

    ``prefix`` is cut anywhere, not only at folder borders, and may hold glob patterns. The file contents are never
    read, so ``tasks`` bounds the number of tasks, of which there would be one per 128 MB of files. As in every Spark
    listing, names that start with ``_`` or ``.`` are left out; ``object_totals`` counts them too.
    """
    return listing(spark, prefix, suffix, tasks).select("path", "length")


def listing(spark: SparkSession, prefix: str, suffix: str | None = None, tasks: int = 1_000) -> DataFrame:
    """The same with ``modified``, the time of the last change."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    try:
        found = reader.load(f"{prefix}*").select("path", "length", F.col("modificationTime").alias("modified"))
        return found.coalesce(tasks)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long, modified timestamp")


def object_totals(spark: SparkSession, prefix: str) -> tuple[int, int]:
    """Number and bytes of all objects whose path starts with ``prefix``, whatever their names begin with.

    The file system adds them up; the driver gets one sum per file or folder right at the prefix.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{prefix}*")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sums = [files.getContentSummary(status.getPath()) for status in files.globStatus(pattern) or []]
    return sum(s.getFileCount() for s in sums), sum(s.getLength() for s in sums)


def folder_day(path: Column) -> Column:
    """The date of a log object, from its folder's name; NULL if the path is none of a log."""
    day = F.regexp_extract(path, rf"/{LOG_FOLDER}/(\d{{{DAY_DIGITS}}})/[^/]+\.log$", 1)
    digits = [F.substring(day, start, length) for start, length in ((1, 4), (5, 2), (7, 2))]
    return F.concat_ws("-", *digits).try_cast("date")


def log_objects(spark: SparkSession, root: str, wanted: list[date] | None = None) -> DataFrame:
    """path, length and log_date of the logs of the wanted days, or of all. Folders of other days are not listed."""
    if wanted == []:
        return spark.createDataFrame([], "path string, length long, log_date date")
    folders = f"{{{','.join(map(nodash, wanted))}}}/" if wanted else ""
    found = list_objects(spark, f"{root}/{LOG_FOLDER}/{folders}", LOG_SUFFIX)
    return found.withColumn("log_date", folder_day(F.col("path"))).where(F.col("log_date").isNotNull())


def stray_objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects below the log folder that no job takes: in a folder that is no date, nested deeper, of another suffix, or
    with a hidden name."""
    found = list_objects(spark, f"{root}/{LOG_FOLDER}/")
    return found.where(folder_day(F.col("path")).isNull()).unionByName(hidden_objects(spark, root))


def hidden_objects(spark: SparkSession, root: str) -> DataFrame:
    """Path and length of objects that no listing has, as a name on their path begins with ``_`` or ``.``.

    The file system's count of each folder below the log folder is held against the listing's. Only folders in which the
    two differ are gone through, by the driver.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(f"{root}/{LOG_FOLDER}/*")
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = F.regexp_extract("path", rf"/{LOG_FOLDER}/([^/]+)", 1)
    by_folder = list_objects(spark, f"{root}/{LOG_FOLDER}/").groupBy(folder.alias("folder")).count().collect()
    listed = {r["folder"]: r["count"] for r in by_folder}
    found: list[tuple[str, int]] = []
    for status in files.globStatus(top) or []:
        path = status.getPath()
        if files.getContentSummary(path).getFileCount() == listed.get(path.getName(), 0):
            continue
        above = path.getParent().toString()
        each = files.listFiles(path, True)
        while each.hasNext():
            one = each.next()
            name = one.getPath().toString()
            if any(part.startswith(("_", ".")) for part in name.removeprefix(above).split("/")):
                found.append((name, one.getLen()))
    return spark.createDataFrame(found, "path string, length long")


def prefix_gate(spark: SparkSession, prefix: str, suffix: str | None = None) -> bool:
    """Whether any object's path starts with ``prefix`` (and ends with ``suffix``)."""
    return not list_objects(spark, prefix, suffix).isEmpty()


def landing_gate(spark: SparkSession, root: str, ds: str | date) -> bool:
    """Whether any log of the day has landed."""
    return not log_objects(spark, root, [as_day(ds)]).isEmpty()


def landing_inventory(spark: SparkSession, root: str, wanted: list[date] | None = None) -> DataFrame:
    """Objects and bytes per day, over the wanted days that have logs, or all days."""
    return inventory(log_objects(spark, root, wanted))


def inventory(objects: DataFrame) -> DataFrame:
    """Objects and bytes per day of ``log_objects``."""
    by_day = objects.groupBy("log_date")
    return by_day.agg(F.count(F.lit(1)).alias("n_objects"), F.sum("length").alias("total_bytes"))


def landing_status(spark: SparkSession, root: str, start: str | date, end: str | date) -> DataFrame:
    """The gate of every day of [start, end), from one listing."""
    calendar = spark.range(len(days(start, end))).select(
        F.date_add(F.lit(as_day(start)), F.col("id").cast("int")).alias("log_date")
    )
    found = landing_inventory(spark, root, days(start, end)).select("log_date", F.lit(True).alias("landed"))
    return calendar.join(found, "log_date", "left").select(
        "log_date", F.coalesce("landed", F.lit(False)).alias("landed")
    )


@dataclass(frozen=True)
class SizeRule:
    """``above`` writers for inputs over the threshold, ``up_to`` for all others.

    With ``bytes_per_writer``, inputs that give each of these more than so many bytes get further writers.
    """

    threshold: int = SIZE_THRESHOLD
    above: int = ABOVE_THRESHOLD
    up_to: int = UP_TO_THRESHOLD
    bytes_per_writer: int | None = None

    def writers(self, total_bytes: int) -> int:
        least = self.above if total_bytes > self.threshold else self.up_to
        return max(least, math.ceil(total_bytes / self.bytes_per_writer)) if self.bytes_per_writer else least

    def column(self, total_bytes: Column) -> Column:
        least = F.when(total_bytes > self.threshold, F.lit(self.above)).otherwise(F.lit(self.up_to))
        if not self.bytes_per_writer:
            return least
        return F.greatest(least, F.ceil(total_bytes / self.bytes_per_writer).cast("int"))


def size_profile(spark: SparkSession, prefix: str, rule: SizeRule = SizeRule()) -> DataFrame:
    """``input_size_profile`` over all objects at the prefix, those with hidden names included."""
    n_objects, total = object_totals(spark, prefix)
    one = spark.range(1).select(F.lit(n_objects).cast("long").alias("n_objects"), F.lit(total).cast("long").alias("total_bytes"))
    return one.withColumn("writers", rule.column(F.col("total_bytes")))


def input_size_profile(listing: DataFrame, rule: SizeRule = SizeRule()) -> DataFrame:
    """One row: total size of the listed objects (0 if there are none) and the number the rule picks."""
    total = listing.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    return total.select("total_bytes", rule.column(F.col("total_bytes")).alias("writers"))
