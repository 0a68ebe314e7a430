"""Incremental log ingest whose result needs no sink log: a folder for each batch, and the number of the last whole one.

A batch writes its rows below ``batch=<number>``, over what a failed try has left there, and then notes its number. Batches
run one after another, so all up to the noted one are whole; readers take these. The note is one small file, however long
the stream has run, and old batches can be moved or dropped by their folders.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.loglines import LineParser
from daytally.sources.files import Files
from daytally.sources.landing import log_objects
from daytally.sources.logs import GOOD, SOURCE_FILE, log_glob, route, stream_lines

COMMIT = "_last_batch.json"


def last_batch(spark: SparkSession, lake: str) -> dict | None:
    """The note: ``batch``, and ``checkpoint``, the folder that counts the batches."""
    files = Files(spark, lake)
    name = f"{lake}/{COMMIT}"
    # A note is replaced by removing it first; the new one is there by then.
    for candidate in (name, f"{name}.new"):
        if files.exists(candidate):
            return json.loads(files.read(candidate))
    return None


def _commit(spark: SparkSession, lake: str, batch: int, checkpoint: str) -> None:
    Files(spark, lake).write(f"{lake}/{COMMIT}", json.dumps({"batch": batch, "checkpoint": checkpoint}))


def stream_batches(
    spark: SparkSession,
    root: str,
    lake: str,
    checkpoint: str,
    parser: LineParser,
    max_files_per_batch: int = 10_000,
    max_file_age: str = "3650d",
    glob: str | None = None,
) -> None:
    """Ingests all new files and stops; each row once, also where a batch fails after its write and is repeated.

    A lake belongs to one checkpoint. ``max_file_age`` and ``glob`` are those of ``stream_ingest``; ``untaken_objects``
    reports the files that they keep out. Read the result with ``read_batches``.
    """
    noted = last_batch(spark, lake)
    if noted and noted["checkpoint"] != checkpoint:
        raise ValueError(f"{lake} is filled from the checkpoint {noted['checkpoint']}; its batches have other numbers")

    def write(rows: DataFrame, batch: int) -> None:
        whole = last_batch(rows.sparkSession, lake)
        if whole and batch <= whole["batch"]:
            return  # noted, but not in the checkpoint's own log
        rows.write.mode("overwrite").partitionBy("kind", "upload_date").parquet(f"{lake}/batch={batch}")
        _commit(rows.sparkSession, lake, batch, checkpoint)

    lines = stream_lines(spark, glob or log_glob(root), max_files_per_batch, max_file_age, with_file=True)
    query = (
        route(lines, parser)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_batches(spark: SparkSession, lake: str, schema: T.StructType, kind: str = GOOD) -> DataFrame:
    """The rows of all whole batches: the fields, line, source_file and upload_date."""
    full = T.StructType([*schema.fields, T.StructField("line", T.StringType()), T.StructField(SOURCE_FILE, T.StringType())])
    for name, of in (("batch", T.LongType()), ("kind", T.StringType()), ("upload_date", T.DateType())):
        full = full.add(name, of)
    noted = last_batch(spark, lake)
    if noted is None:
        return spark.createDataFrame([], full).drop("batch", "kind")
    try:
        rows = spark.read.schema(full).option("basePath", lake).parquet(f"{lake}/batch=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], full)
    return rows.where((F.col("batch") <= noted["batch"]) & (F.col("kind") == kind)).drop("batch", "kind")


def untaken_objects(spark: SparkSession, root: str, lake: str, schema: T.StructType) -> DataFrame:
    """Logs that are not empty and of which no whole batch has a line: new ones, and those beyond ``max_file_age``."""
    from daytally.sources.logs import REJECTS

    taken = read_batches(spark, lake, schema).select(SOURCE_FILE).unionByName(
        read_batches(spark, lake, schema, REJECTS).select(SOURCE_FILE)
    )
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    taken = taken.distinct().select(plain(F.col(SOURCE_FILE)).alias("taken"))
    found = log_objects(spark, root).where("length > 0")
    return found.join(taken, plain(F.col("path")) == F.col("taken"), "left_anti")
