"""Scans of the raw log objects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.dates import as_day, nodash
from daytally.functions.loglines import LineParser
from daytally.sources.landing import DAY_DIGITS, LOG_FOLDER, LOG_SUFFIX, folder_day

GOOD = "good"
REJECTS = "rejects"
SOURCE_FILE = "source_file"


def log_glob(root: str, ds: str | date | None = None) -> str:
    """The log objects of one day, or of all days: folders whose whole name is the date."""
    return f"{root}/{LOG_FOLDER}/{nodash(ds) if ds else '[0-9]' * DAY_DIGITS}/*{LOG_SUFFIX}"


def month_glob(root: str, year: int, month: int) -> str:
    """The log objects of a month, for a stream that need not list the whole history."""
    return f"{root}/{LOG_FOLDER}/{year:04d}{month:02d}[0-9][0-9]/*{LOG_SUFFIX}"


def scan_lines(spark: SparkSession, glob: str, ds: str | date | None = None) -> DataFrame:
    """Lines with the upload date of their folder. A known day spares reading it off each path."""
    return with_upload_date(spark.read.format("text").load(glob), ds)


def stream_lines(
    spark: SparkSession, glob: str, max_files_per_batch: int, max_file_age: str, with_file: bool = False
) -> DataFrame:
    reader = spark.readStream.format("text").options(maxFilesPerTrigger=max_files_per_batch, maxFileAge=max_file_age)
    return with_upload_date(reader.load(glob), None, with_file)


def with_upload_date(lines: DataFrame, ds: str | date | None, with_file: bool = False) -> DataFrame:
    """The lines with their folder's date. Those of a folder like 20241399 have none and are left out, as in listings."""
    day: Column = F.lit(as_day(ds)) if ds else folder_day(F.col("_metadata.file_path"))
    file = [F.col("_metadata.file_path").alias(SOURCE_FILE)] if with_file else []
    dated = lines.select(F.col("value").alias("line"), day.alias("upload_date"), *file)
    return dated if ds else dated.where(F.col("upload_date").isNotNull())


def route(lines: DataFrame, parser: LineParser) -> DataFrame:
    """Each line as a ``good`` row with its fields, or as a ``rejects`` row that keeps the line."""
    file = [c for c in lines.columns if c == SOURCE_FILE]
    parsed = lines.select("line", "upload_date", parser.parse(F.col("line")).alias("record"), *file)
    judged = parsed.withColumn("failed", parser.failed(F.col("record"), F.col("line")))
    return judged.select(
        *[F.when(~F.col("failed"), F.col("record")[name]).alias(name) for name in parser.schema.names],
        F.when(F.col("failed"), F.col("line")).alias("line"),
        F.when(F.col("failed"), F.lit(REJECTS)).otherwise(F.lit(GOOD)).alias("kind"),
        *file,
        "upload_date",
    )
