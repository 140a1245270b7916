"""Ground truth kept merged as forecasts land: one row per city and hour, by day.

A version writes the days that its documents touch, anew and whole, and a list of all days with the version that
holds each. So a reader opens one folder per day, whose rows need no further aggregation, and pays nothing for days that
were not asked for. Versions and what they mean to readers are those of ``versions``.

Merging keeps, per city and hour, the smaller rank of ``payloads.ranked_hours``. That does not depend on the order in
which documents land, nor on how often: landing one again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.schemas import TRUTH_DAY, TRUTH_ROW
from wxspark.sources import payloads
from wxspark.sources.versions import Versions

#: Days that a batch may ask for by the names of their folders; for more, all days are listed and joined.
MOST_DAYS = 1_000


class TruthStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, self.path)

    def days(self) -> DataFrame:
        """day and the version whose folder holds it, as of the current version; a row per day."""
        current = self.versions.current()
        if current is None:
            return self.spark.createDataFrame([], TRUTH_DAY)
        return self.spark.read.schema(TRUTH_DAY).parquet(f"{self.path}/days/version={current}")

    def _folder(self, day, version: int) -> str:
        return f"{self.path}/hours/version={version}/day={day}"

    def _rows(self, asked: DataFrame) -> DataFrame:
        """Rows (with their ranks) of the days in the column ``day`` of ``asked``."""
        wanted = self.days().join(asked.select("day").distinct(), "day", "left_semi")
        found = wanted.limit(MOST_DAYS + 1).collect()
        if not found:
            return self.spark.createDataFrame([], TRUTH_ROW)
        if len(found) <= MOST_DAYS:
            return self.spark.read.schema(TRUTH_ROW).parquet(*[self._folder(r.day, r.version) for r in found])
        everything = self.spark.read.parquet(f"{self.path}/hours")  # partitions version and day
        kept = everything.join(F.broadcast(wanted), ["version", "day"], "left_semi")
        return kept.select(*TRUTH_ROW.fieldNames())

    def read(self, asked: DataFrame) -> DataFrame:
        """Ground truth, as ``payloads.ground_truth`` gives it, of the days in ``asked``."""
        return payloads.as_truth(self._rows(asked))

    def read_all(self) -> DataFrame:
        return self.read(self.days())

    def merge(self, hours: DataFrame) -> int | None:
        """Take in hours of documents that have landed; the new version, or None if none of them counts."""
        number = self.versions.next()
        landed = f"{self.path}/landed/version={number}"
        day = F.col("hour_at").cast("date").alias("day")
        payloads.newest(payloads.ranked_hours(hours)).write.mode("overwrite").parquet(landed)
        new = self.spark.read.schema(TRUTH_ROW).parquet(landed)
        changed = new.select(day).distinct()
        if changed.isEmpty():
            return None
        merged = payloads.newest(new.unionByName(self._rows(changed)))
        (
            merged.withColumn("day", day)
            .repartitionByRange("day", "city", "hour_at")  # few files a day, and a large day over several tasks
            .sortWithinPartitions("day", "city", "hour_at")
            .write.mode("overwrite")
            .partitionBy("day")
            .parquet(f"{self.path}/hours/version={number}")
        )
        kept = self.days().join(changed, "day", "left_anti")
        listed = kept.unionByName(changed.withColumn("version", F.lit(number)))
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/days/version={number}")
        self.versions.commit(number)
        return number
