"""Logs to lake: one pass over the text, good rows and rejected lines in one write."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daytally.functions.dates import as_day
from daytally.functions.loglines import LineParser
from daytally.sources.lake import dataset
from daytally.sources.landing import SizeRule, input_size_profile, log_objects
from daytally.sources.logs import GOOD, REJECTS, log_glob, route, scan_lines

def write_lake(routed: DataFrame, lake: str, mode: str) -> None:
    """``overwrite`` replaces the folders that occur in ``routed``. No shuffle: a hot day just has more files."""
    (
        routed.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("kind", "upload_date")
        .parquet(lake)
    )


def ingest_logs(spark: SparkSession, root: str, lake: str, parser: LineParser) -> None:
    """The logs of all days into a new lake, in one job. Days are read off the folder names.

    Fails if the lake exists: days are added to it, or done again, with ``ingest_day``.
    """
    write_lake(route(scan_lines(spark, log_glob(root)), parser), lake, "errorifexists")


def ingest_day(
    spark: SparkSession,
    root: str,
    lake: str,
    ds: str | date,
    parser: LineParser,
    size_rule: SizeRule | None = None,
) -> dict[str, int] | None:
    """One day of logs into the lake, replacing what the lake has of that day. Returns the row counts by kind.

    Without any log of the day, nothing is written and None comes back. With ``size_rule`` the files written are
    limited to the number the input's size picks.
    """
    ds = as_day(ds)
    try:
        lines = scan_lines(spark, log_glob(root, ds), ds)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    routed = route(lines, parser)
    if size_rule:
        # Narrow: fewer, larger tasks over the same splits, no shuffle.
        routed = routed.coalesce(writers_for(spark, root, ds, size_rule))
    counts = Observation()
    observed = routed.observe(
        counts,
        *[F.count(F.when(F.col("kind") == kind, 1)).alias(kind) for kind in (GOOD, REJECTS)],
    )
    write_lake(observed, lake, "overwrite")
    written = {kind: counts.get[kind] for kind in (GOOD, REJECTS)}
    for kind, rows in written.items():
        if rows == 0:
            # The write above leaves the folders of a kind without rows as an earlier run left them.
            empty = routed.drop("kind", "upload_date").where(F.lit(False))
            empty.write.mode("overwrite").parquet(f"{dataset(lake, kind)}/upload_date={ds}")
    return written


def writers_for(spark: SparkSession, root: str, ds: str | date, rule: SizeRule) -> int:
    """The number the size rule picks for a day's logs."""
    return input_size_profile(log_objects(spark, root, [as_day(ds)]), rule).first()["writers"]


