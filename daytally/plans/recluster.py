"""Clustering that lasts over loads: of each day only the files whose key ranges overlap are written anew.

Every load is clustered by itself, so after some loads a key of a day lies in one file of each. The range of each file is
read off the key columns, without the others. Files whose ranges overlap, directly or through others, are one group; a
group is clustered again and put in the place of its files. Files that overlap with none stay as they are.

A table of plain files has no transactions. The new files are written beside the table first, then a journal that names
them and the old ones; from then on the change is done for, as the next call carries out what a journal says. Readers
must wait while a day is swapped, and so must loads.
"""

from __future__ import annotations

import json
import math
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daytally.plans.load import BYTES_PER_PARTITION, clustered
from daytally.sources.files import Files

JOURNAL = "_recluster"


def file_ranges(spark: SparkSession, table: str, key: tuple[str, ...], days: list[date] | None = None) -> DataFrame:
    """event_day, path, bytes, least and most key of every file of the table, or of some days."""
    rows = spark.table(table)
    if days is not None:
        rows = rows.where(F.col("event_day").isin(days))
    whole = F.struct(*key)
    return rows.groupBy("event_day", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.min(whole).alias("least"), F.max(whole).alias("most")
    )


def overlap_groups(ranges: DataFrame) -> DataFrame:
    """The ranges with ``group``: files of a day that overlap, directly or through others, have the same number.

    Ranges that share no more than an end do not overlap: a value may fill the end of one file and the start of the next.
    """
    of_day = Window.partitionBy("event_day").orderBy("least", "most", "path")
    reached = F.max("most").over(of_day.rowsBetween(Window.unboundedPreceding, -1))
    apart: Column = F.coalesce(F.col("least") >= reached, F.lit(True)).cast("int")
    return ranges.withColumn("group", F.sum(apart).over(of_day))


def overlaps(ranges: DataFrame) -> DataFrame:
    """Per day: files, files that overlap with another, and the most files that any one key may be in."""
    of_group = Window.partitionBy("event_day", "group")
    grouped = overlap_groups(ranges).withColumn("size", F.count(F.lit(1)).over(of_group))
    counted = grouped.groupBy("event_day").agg(
        F.count(F.lit(1)).alias("n_files"), F.count(F.when(F.col("size") > 1, 1)).alias("n_overlapping")
    )
    # An end goes before a start at the same key.
    ends = ranges.select("event_day", F.col("most").alias("at"), F.lit(-1).alias("step"))
    steps = ranges.select("event_day", F.col("least").alias("at"), F.lit(1).alias("step")).unionByName(ends)
    running = F.sum("step").over(Window.partitionBy("event_day").orderBy("at", "step"))
    depth = steps.withColumn("open", running).groupBy(F.col("event_day").alias("of_day")).agg(
        F.greatest(F.max("open"), F.lit(1)).alias("depth")
    )
    return counted.join(depth, F.col("event_day").eqNullSafe(F.col("of_day"))).drop("of_day")


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    return described["data_type"].rstrip("/")


def finish(spark: SparkSession, table: str) -> int:
    """Carries out what journals say that a call before has left. Each step may have been done already."""
    files = Files(spark, _location(spark, table))
    journals = [n for n in files.names(f"{files.location}/{JOURNAL}") if n.endswith(".json")]
    for name in journals:
        journal = json.loads(files.read(name))
        for staged, final in journal["move"]:
            if files.system.exists(files.path(staged)):
                files.system.mkdirs(files.path(final).getParent())
                if not files.system.rename(files.path(staged), files.path(final)):
                    raise RuntimeError(f"could not move {staged}")
        for old in journal["remove"]:
            files.system.delete(files.path(old), False)
        files.system.delete(files.path(name), False)
        files.system.delete(files.path(journal["folder"]), True)
    spark.catalog.refreshTable(table)
    return len(journals)


def recluster(
    spark: SparkSession,
    table: str,
    event_time: str = "start_time",
    cluster_by: tuple[str, ...] = ("user_id",),
    days: list[date] | None = None,
    least_files: int = 2,
) -> int:
    """Clusters anew the groups of overlapping files of the days, by default all; returns how many files it replaced.

    A group of less than ``least_files`` files waits for more. One job for each group: its size is that of the group.
    """
    finish(spark, table)
    files = Files(spark, _location(spark, table))
    found = overlap_groups(file_ranges(spark, table, (*cluster_by, event_time), days))
    groups = (
        found.groupBy("event_day", "group")
        .agg(F.collect_list("path").alias("paths"), F.sum("bytes").alias("bytes"))
        .where((F.size("paths") >= max(2, least_files)) & F.col("event_day").isNotNull())
        .orderBy("event_day", "group")
        .collect()
    )
    columns = [c for c in spark.table(table).columns if c != "event_day"]
    for group in groups:
        folder = f"{files.location}/{JOURNAL}/{uuid.uuid4().hex}"
        rows = spark.read.schema(spark.table(table).select(*columns).schema).parquet(*group["paths"])
        partitions = max(1, math.ceil(group["bytes"] / BYTES_PER_PARTITION))
        clustered(rows, event_time, cluster_by, partitions).select(*columns).write.parquet(folder)
        made = [n for n in files.below(folder) if n.endswith(".parquet")]
        day = f"{files.location}/event_day={group['event_day']}"
        move = [(n, f"{day}/{n.rpartition('/')[2]}") for n in made]
        journal = {"folder": folder, "move": move, "remove": list(group["paths"])}
        files.write(f"{folder}.json", json.dumps(journal))
        finish(spark, table)
    return sum(len(g["paths"]) for g in groups)
