"""Counts and model scores; each is one aggregate with map-side partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.functions.display import decimals_text, percent_text


def accuracy(label: Column, prediction: Column) -> Column:
    return F.avg((label == prediction).cast("int"))


def precision(label: Column, prediction: Column) -> Column:
    """TP / (TP + FP) of class 1; 0 when nothing was predicted positive."""
    predicted = F.count_if(prediction == 1)
    hits = F.count_if((prediction == 1) & (label == 1))
    return F.coalesce(hits / F.nullif(predicted, F.lit(0)), F.lit(0.0))


def mean_absolute_error(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def row_counts(df: DataFrame, by: str) -> DataFrame:
    """Rows per value and, under ``All Data``, in total: one pass, the total is rolled up from the counts."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    counts = counts.rollup(by).agg(F.sum("n").alias("n_rows"), F.grouping(by).alias("total"))
    return counts.select(F.when(F.col("total") == 1, "All Data").otherwise(F.col(by)).alias(by), "n_rows")


def as_rows(scores: DataFrame, columns: list[str]) -> DataFrame:
    """One wide row of scores named ``model__metric`` to rows (model, metric, value)."""
    long = scores.unpivot([], columns, "name", "value")
    parts = F.split("name", "__")
    return long.select(parts[0].alias("model"), parts[1].alias("metric"), "value")


def display_metrics(scores: DataFrame) -> DataFrame:
    """Rows (model, metric, value) with the ``headline`` and the ``detail`` shown for them, null where none is."""
    model, value = F.col("model"), F.col("value")
    error = F.col("metric") == "mae"
    headline = (
        F.when(~error, percent_text(value))
        .when(model == "temp_celsius", F.concat(decimals_text(value, 2), F.lit("°C")))
        .when(model == "humidity_percent", F.concat(decimals_text(value, 2), F.lit("%")))
    )
    detailed = error & model.isin("temp_celsius", "wind_speed_kmh", "precipitation_mm")
    return scores.withColumns({"headline": headline, "detail": F.when(detailed, decimals_text(value, 4))})
