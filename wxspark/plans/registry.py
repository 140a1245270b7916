"""Fitted models by version, so that a reader never meets half of one."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.plans import train
from wxspark.plans.verify import Predictor
from wxspark.sources.versions import Versions


class Registry:
    """``version=<n>/model`` (to load with pyspark.ml), ``grid`` and ``metrics`` under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, self.path)

    def publish(self, job: train.Trained) -> int:
        """Write all parts of a new version, then make it the current one."""
        number = self.versions.next()
        train.save_model(job.model, self._part("model", number))
        job.grid.coalesce(1).write.mode("overwrite").parquet(self._part("grid", number))
        job.metrics().coalesce(1).write.mode("overwrite").parquet(self._part("metrics", number))
        self.versions.commit(number)
        return number

    def _part(self, name: str, number: int) -> str:
        return f"{self.path}/version={number}/{name}"

    def current(self) -> int:
        number = self.versions.current()
        if number is None:
            raise FileNotFoundError(f"no model has been published under {self.path}")
        return number

    def grid(self, number: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._part("grid", number or self.current()))

    def metrics(self, number: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._part("metrics", number or self.current()))

    def model(self, number: int | None = None) -> PipelineModel:
        return train.load_model(self._part("model", number or self.current()))

    def predictor(self) -> Predictor:
        """Predicts with the version that is current when a plan is made, as for each micro-batch, and names it in
        ``model_version``."""

        def predict(requests: DataFrame) -> DataFrame:
            number = self.current()
            return train.model_predictions(self.grid(number))(requests).withColumn("model_version", F.lit(number))

        return predict
