"""A table of the objects that have landed, so that a run lists only the folders that can still change.

One partition per month of the folders' names, and one for folders that are no month. An update lists some months and
puts what it finds in the place of their partitions; the others are neither listed nor written. What the driver holds of
a listing is that of those months.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daytally.functions.dates import as_day
from daytally.sources.landing import LOG_FOLDER, LOG_SUFFIX, SizeRule, folder_day, input_size_profile, inventory, listing

NO_MONTH = "none"
SCHEMA = "path string, length long, modified timestamp, log_date date, month string"


def _month(folder: Column) -> Column:
    """The first six digits of a folder's name that begins with them."""
    return F.when(folder.rlike("^[0-9]{6}"), F.substring(folder, 1, 6)).otherwise(F.lit(NO_MONTH))


@dataclass(frozen=True)
class Manifest:
    """``path``: the table's folder. ``root``: what ``logs/`` is in."""

    spark: SparkSession
    path: str
    root: str

    def _system(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def months(self) -> list[str]:
        """Months that the log folders' names begin with: names only, without what is in them."""
        path, system = self._system()
        top = path(f"{self.root}/{LOG_FOLDER}/*")
        found = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(top)
        names = [status.getPath().getName() for status in found or []]
        return sorted({name[:6] for name in names if name[:6].isdigit() and len(name) >= 6})

    def update(self, since: str | date | None = None) -> list[str]:
        """Lists the months from that of ``since`` on, or all folders, and returns the months it has listed.

        A month of the table whose folders are gone goes too, if it is among those listed.
        """
        held = self.held()
        if since is None:
            months = sorted({*self.months(), *held, NO_MONTH})
            found = listing(self.spark, f"{self.root}/{LOG_FOLDER}/")
        else:
            first = as_day(since).strftime("%Y%m")
            months = sorted({m for m in (*self.months(), *held) if m != NO_MONTH and m >= first})
            if not months:
                return []
            found = listing(self.spark, f"{self.root}/{LOG_FOLDER}/{{{','.join(months)}}}")
        folder = F.regexp_extract("path", rf"/{LOG_FOLDER}/([^/]+)/", 1)
        rows = found.select(
            "path",
            "length",
            "modified",
            F.when(F.col("path").endswith(LOG_SUFFIX), folder_day(F.col("path"))).alias("log_date"),
            _month(folder).alias("month"),
        )
        counted = Observation()
        seen = rows.observe(counted, F.collect_set("month").alias("months"))
        writer = seen.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("month").parquet(self.path)
        # An overwrite without rows for a month leaves what it had.
        path, system = self._system()
        for month in set(months).intersection(held).difference(counted.get["months"]):
            system.delete(path(f"{self.path}/month={month}"), True)
        return months

    def held(self) -> list[str]:
        path, system = self._system()
        found = system.globStatus(path(f"{self.path}/month=*"))
        return sorted(status.getPath().getName().partition("=")[2] for status in found or [])

    def objects(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    # What reads it

    def log_objects(self, wanted: list[date] | None = None) -> DataFrame:
        """As ``landing.log_objects``; the wanted days' months are the only partitions read."""
        rows = self.objects().where(F.col("log_date").isNotNull())
        if wanted is not None:
            months = sorted({day.strftime("%Y%m") for day in wanted})
            rows = rows.where(F.col("month").isin(months) & F.col("log_date").isin(wanted))
        return rows.select("path", "length", "log_date")

    def gate(self, ds: str | date) -> bool:
        return not self.log_objects([as_day(ds)]).isEmpty()

    def inventory(self, wanted: list[date] | None = None) -> DataFrame:
        return inventory(self.log_objects(wanted))

    def size_profile(self, rule: SizeRule = SizeRule()) -> DataFrame:
        """The size rule over all objects below the log folder that have been listed."""
        return input_size_profile(self.objects(), rule)

    def stray_objects(self) -> DataFrame:
        """Listed objects that no job takes."""
        return self.objects().where(F.col("log_date").isNull()).select("path", "length")
