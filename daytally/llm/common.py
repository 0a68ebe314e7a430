"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.session import run_dir, shuffles_dropped

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
LOWER_BYTES = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A to Z in lower case; every other character stays as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def written(rows: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Writes the rows to the cluster's shared folder, partitioned by a last column if one is named; reads them back.

    It cuts the lineage: a lost executor costs its running tasks and none of the work before. The shuffle files of the
    write go with it.
    """
    return written_at(rows, label, by)[0]


def written_at(rows: DataFrame, label: str, by: str | None = None) -> tuple[DataFrame, str]:
    """The same, with the table's folder, for ``discard``."""
    spark = rows.sparkSession
    path = run_dir(spark, label)
    with shuffles_dropped(spark):
        (rows.write.partitionBy(by) if by else rows.write).parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes tables of ``written_at`` that nothing will read again, as what came of them is in tables itself."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
