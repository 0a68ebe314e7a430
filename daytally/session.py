"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings, safe to apply to a session that already runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A value that does not fit stops the run. Otherwise it would become NULL and be missing from a sum unseen.
    "spark.sql.ansi.enabled": "true",
    # Let AQE swap a sort-merge join for a hash join once the measured side is small enough in every partition.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    # Nearly every aggregate here is by user. With millions of groups per task the small first-level map only costs:
    # without it the daily aggregate of 40 million rows took 11.5 s instead of 14.2 s, and few groups were no slower.
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
}

SHARED_DIR_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, build your own and call ``configure``."""
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daytally")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go as soon as it ends, not when the driver's JVM happens to collect garbage.

    For writes that are read again from the table: a DataFrame that is itself run twice would look for its old files.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_KEY)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_KEY, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach. Only a local session without the setting gets a folder of its own."""
    folder = spark.conf.get(SHARED_DIR_KEY, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder shared by the cluster (master is {master})")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_dirs[application]


def run_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/daytally-{label}-{uuid.uuid4().hex}"
