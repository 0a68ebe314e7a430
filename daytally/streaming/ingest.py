"""Incremental log ingest: each run takes the log files that no run has taken yet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from daytally.functions.loglines import LineParser
from daytally.sources.logs import log_glob, route, stream_lines


def stream_ingest(
    spark: SparkSession,
    root: str,
    lake: str,
    checkpoint: str,
    parser: LineParser,
    max_files_per_batch: int = 10_000,
    max_file_age: str = "3650d",
    glob: str | None = None,
) -> None:
    """Ingests all new files and stops. No state besides the list of files taken, so no watermark.

    A file whose modification time lies more than ``max_file_age`` before the newest file taken is passed over for
    good. Spark's own default of 7 days loses logs that were copied with their old times or came late, so the default
    here is far above any delay. The price: the driver remembers every file taken within that age (about 200 bytes
    each), and each run lists what ``glob`` matches. Where the history is long, give a ``glob`` of the months that can
    still change (``logs.month_glob``), and a shorter age if no file is ever that old. The checkpoint and the sink's
    ``_spark_metadata`` list all files too; start a new lake folder and checkpoint, for instance each year, to drop them.

    Read the result at ``lake`` itself and filter on ``kind``: the sink's log there names the committed files, which
    keeps the rows of a failed and repeated batch from showing twice.
    """
    query = (
        route(stream_lines(spark, glob or log_glob(root), max_files_per_batch, max_file_age), parser)
        .writeStream.format("parquet")
        .partitionBy("kind", "upload_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(lake)
    )
    query.awaitTermination()
