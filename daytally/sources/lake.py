"""Reads of the Parquet lake: ``<lake>/kind=<good|rejects>/upload_date=<date>/*.parquet``."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.dates import as_day, days
from daytally.sources.logs import GOOD, REJECTS


def dataset(lake: str, kind: str = GOOD) -> str:
    """Root of one kind of rows, laid out by upload date."""
    return f"{lake}/kind={kind}"


def read_events(
    spark: SparkSession, lake: str, schema: T.StructType, ds: str | date | None = None, end: str | date | None = None
) -> DataFrame:
    """All days; the day ``ds``; or with ``end`` the days of [ds, end). Only the folders asked for are listed."""
    return _read(spark, dataset(lake, GOOD), schema, ds, end)


def read_rejects(
    spark: SparkSession, lake: str, ds: str | date | None = None, end: str | date | None = None
) -> DataFrame:
    return _read(spark, dataset(lake, REJECTS), T.StructType().add("line", "string"), ds, end)


def misplaced(events: DataFrame) -> DataFrame:
    """One row: ``no_upload_time``, rows without one, and ``off_day``, rows whose upload time is not on their folder's day.

    Neither counts in a daily run that reads its day's folder. Of the columns only these two are read.
    """
    off = F.to_date("upload_time") != F.col("upload_date")
    return events.agg(
        F.count(F.when(F.col("upload_time").isNull(), 1)).alias("no_upload_time"), F.count(F.when(off, 1)).alias("off_day")
    )


def _read(spark: SparkSession, root: str, schema: T.StructType, ds: str | date | None, end: str | date | None) -> DataFrame:
    """Listing a whole lake to read some days costs more than the days."""
    full = T.StructType([*schema.fields, T.StructField("upload_date", T.DateType())])
    reader = spark.read.schema(full).option("basePath", root)
    wanted = days(ds, end) if ds and end else [as_day(ds)] if ds else None
    if wanted == []:
        return spark.createDataFrame([], full)
    folders = f"{root}/upload_date={{{','.join(map(str, wanted))}}}" if wanted else root
    try:
        found = reader.parquet(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    if not wanted:
        return found
    day = F.col("upload_date")
    return found.where((day >= F.lit(wanted[0])) & (day <= F.lit(wanted[-1])))
