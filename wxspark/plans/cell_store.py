"""Training cells that are kept merged as observations land, so that training again reads only what is new.

Cells are exact sums, so those of two sets of files add up to those of both. Files that have been taken in are known by the
progress of a file stream under the store; a batch of files is merged into a new version of the cells, which has the
batch's own number, so that a batch that is run again after a failure is not counted twice. Test rows cannot be summed
up, as absolute errors are asked of them: they are kept by version as they come, with nothing but what scores need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.constants import FEATURES, TARGETS
from wxspark.operators.sampling import split_bucket
from wxspark.plans import train
from wxspark.schemas import OBSERVATION
from wxspark.sources.tables import CSV_OPTIONS
from wxspark.sources.versions import Versions
from wxspark.streaming.verify_stream import for_each_batch

_KEYS = [*FEATURES, "replicate", "extreme"]


class CellStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, self.path)

    def take_in(self, observations: str, max_files: int = 100_000) -> int | None:
        """Add the files of a folder that have not been added yet; the version after that, None if there is none."""
        reader = self.spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", max_files)
        if observations.rstrip("/").endswith(".csv"):
            landed = reader.options(mode="FAILFAST", **CSV_OPTIONS).csv(observations)
        else:
            landed = reader.parquet(observations)
        for_each_batch(landed, self._add, f"{self.path}/progress", availableNow=True).awaitTermination()
        return self.versions.current()

    def _add(self, batch: DataFrame, batch_id: int) -> None:
        number = batch_id + 1
        if number in self.versions.numbers():
            return  # taken in before a failure
        if self.versions.next() != number:
            raise RuntimeError(f"{self.path} has version {self.versions.current()}, its files' progress batch {batch_id}")
        flagged = split_bucket(train.training_rows(batch))
        test = flagged.where("is_test").select(*FEATURES, "extreme", *TARGETS)
        test.write.mode("overwrite").parquet(f"{self.path}/test/version={number}")
        cells = train.training_cells(flagged.where(~F.col("is_test")))
        if number > 1:
            cells = _added(cells.unionByName(self.cells()))
        cells.coalesce(train.FIT_PARTITIONS).write.mode("overwrite").parquet(f"{self.path}/cells/version={number}")
        self.versions.commit(number)

    def _current(self) -> int:
        number = self.versions.current()
        if number is None:
            raise FileNotFoundError(f"no observations have been taken in under {self.path}")
        return number

    def cells(self) -> DataFrame:
        """The cells of all training rows taken in."""
        return self.spark.read.parquet(f"{self.path}/cells/version={self._current()}")

    def test_rows(self) -> DataFrame:
        """Features, label and targets of all test rows taken in."""
        current = self._current()
        return self.spark.read.parquet(*[f"{self.path}/test/version={v}" for v in self.versions.numbers() if v <= current])

    def train(self) -> train.Trained:
        """The forests of everything taken in: those that one training on all the files gives."""
        test = self.test_rows()
        model = train.fit_forests(self.cells())
        return train.Trained(model, train.prediction_grid(self.spark, model), test)


def _added(cells: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("weight", *(f"{t}_hundredths" for t in TARGETS))]
    return cells.groupBy(*_KEYS).agg(*sums)
