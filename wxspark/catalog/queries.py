"""One query per operator: ``QUERIES[name](spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.catalog import fixtures as fx
from wxspark.constants import ATTRIBUTES, REGIMES, TARGETS
from wxspark.functions import calendar, rules
from wxspark.operators import metrics, sampling
from wxspark.operators.units import rename_units
from wxspark.plans import jobs, timeline, train, verify
from wxspark.plans.cell_store import CellStore
from wxspark.session import scratch_path
from wxspark.sources import dims, generate, payloads, requests, tables
from wxspark.sources.truth_store import TruthStore
from wxspark.streaming.verify_stream import verify_stream, verify_stream_refreshed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_trained: dict[tuple[str, str], train.Trained] = {}
_landed: dict[tuple[str, str], str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def trained(spark: SparkSession, sf_dir: str) -> train.Trained:
    """The forests of this session for these tables, fitted once, on targets that are steps of the hour."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trained:
        _trained[key] = train.train(fx.stepped(spark, sf_dir))
    return _trained[key]


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.parse_requests(fx.bodies(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid requests with their time columns."""
    checked = requests.validate_requests(_requests(spark, sf_dir))
    return verify.with_request_time(verify.accepted(checked))


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth, landed once for this session and these tables in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        path = scratch_path(spark, "truth")
        payloads.ground_truth(payloads.payload_hours(fx.payloads(spark, sf_dir))).write.parquet(path)
        _landed[key] = path
    return spark.read.parquet(_landed[key])


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.verify(fx.bodies(spark, sf_dir), fx.drawn_predictions, _truth(spark, sf_dir))


# Sources and dimensions


@query
def id_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.id_range(spark, fx.ids(spark, sf_dir).count(), 10)


@query
def city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension with the number of requests for each city."""
    asked = fx.requests_of(fx.events(spark, sf_dir)).groupBy("city").agg(F.count("*").alias("n_requests"))
    return dims.city_dim(spark).join(asked, "city", "left").fillna(0, "n_requests")


@query
def regime_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension against the generated rows: per type, rows and rows within every bound."""
    joined = fx.regimes(spark, sf_dir).join(F.broadcast(dims.regime_dim(spark)), "weather")
    inside = F.lit(True)
    for a in ATTRIBUTES:
        inside = inside & F.col(a).between(F.col(f"{a}_lo"), F.col(f"{a}_hi"))
    keys = ["regime_no", "weather"] + [f"{a}_{edge}" for a in ATTRIBUTES for edge in ("lo", "hi")]
    return joined.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_if(inside).alias("n_inside"))


# Generation and projection


@query
def gen_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observations(spark, sf_dir).drop("is_extreme_weather")


@query
def gen_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.regimes(spark, sf_dir).drop("row_no")


@query
def union_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five types' folders, each read alone, put together again."""
    path = scratch_path(spark, "regimes")
    tables.write_regimes(fx.regimes(spark, sf_dir), path)
    return tables.union_regimes([tables.read_regimes(spark, path, weather) for weather in REGIMES])


@query
def label_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observations(spark, sf_dir).select("id", "temp_celsius", "is_extreme_weather")


@query
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = train.calendar_features(fx.observations(spark, sf_dir))
    return rows.select("id", "timestamp", "month", "day", "hour")


@query
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector, shown as an array, with the label and the targets."""
    from pyspark.ml.functions import vector_to_array

    rows = train.feature_matrix(train.training_rows(fx.observations(spark, sf_dir)))
    features = vector_to_array("features")
    return rows.select(
        "id", *[features[i].alias(f"feature_{name}") for i, name in enumerate(("month", "day", "hour"))], "extreme", *TARGETS
    )


@query
def rename_units_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_units(fx.regimes(spark, sf_dir).drop("row_no"))


# Requests


@query
def parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir)


@query
def default_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with an unmapped city or a bad date falls back to the form's defaults."""
    rows = fx.requests_of(fx.events(spark, sf_dir)).select(
        "id",
        F.when(F.col("date") != "garbage", F.nullif("date", F.lit(""))).alias("date"),
        F.when(F.col("city") != fx.UNMAPPED_CITY, F.col("city")).alias("city"),
    )
    return requests.default_requests(rows, fx.NOW)


@query
def validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests.validate_requests(_requests(spark, sf_dir))
    return rows.select("id", "date", "city", "requested_at", "error")


@query
def city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.lookup_city(_requests(spark, sf_dir)).select("id", "city", "lat", "lon", "timezone", "label")


@query
def hour_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.events(spark, sf_dir).select(F.col("event_id").alias("id"), "ts")
    return rows.select("id", calendar.hour_key(F.col("ts")).alias("hour_key"), calendar.to_hour(F.col("ts")).alias("hour_at"))


# Ground truth


@query
def ground_truth_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.payload_hours(fx.payloads(spark, sf_dir))


@query
def ground_truth_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = payloads.lookup_truth(_valid(spark, sf_dir), _truth(spark, sf_dir), "id")
    return found.select("id", "city", "hour_key", "real_found", *[f"real_{t}" for t in TARGETS])


@query
def ground_truth_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup by the plan used beyond the broadcast bound, which is set low for it."""
    found = payloads.lookup_truth(_valid(spark, sf_dir), _truth(spark, sf_dir), "id", broadcast_rows=100)
    return found.select("id", "city", "hour_key", "real_found", *[f"real_{t}" for t in TARGETS])


@query
def ground_truth_lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That plan again, with the ground truth as a table in buckets, which it does not shuffle."""
    path = scratch_path(spark, "truth-table")
    name = "truth_" + path.rsplit("-", 1)[1]
    tables.save_table(_truth(spark, sf_dir), name, path, by=("city", "hour_at"))
    found = payloads.lookup_truth(_valid(spark, sf_dir), spark.table(name), "id", broadcast_rows=100)
    return found.select("id", "city", "hour_key", "real_found", *[f"real_{t}" for t in TARGETS])


@query
def ground_truth_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth merged as the documents land in three parts, one of them twice."""
    documents = fx.payloads(spark, sf_dir)
    store = TruthStore(spark, scratch_path(spark, "truth-store"))
    for part in (2, 0, 1, 0):
        landed = documents.where(F.pmod(F.xxhash64("city", "issued"), F.lit(3)) == part)
        store.merge(payloads.payload_hours(landed))
    return store.read_all().drop("real_found")


# Verdicts


@query
def season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season of every observation's date at every city's latitude (cities assigned by id)."""
    rows = train.calendar_features(fx.observations(spark, sf_dir)).select("id", "month")
    cities = requests.lookup_city(rows.withColumn("city", F.array(*map(F.lit, fx.CITY_NAMES))[(F.col("id") % 6).cast("int")]))
    # Months of the table, then moved on by the id so that every month occurs.
    month = (F.col("month") + F.col("id")) % 12 + 1
    return cities.select("id", "city", month.cast("int").alias("month"), calendar.season(month, F.col("lat")).alias("season"))


@query
def deviation_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.accepted(_rules(spark, sf_dir)).select("id", "ai_temp_celsius", "real_temp_celsius", "deviation", "verdict")


@query
def alert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.observations(spark, sf_dir)
    return rows.select("id", rules.alert(F.col("is_extreme_weather")).alias("alert"))


@query
def display_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.display_fields(_rules(spark, sf_dir))


@query
def result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.result_json(_rules(spark, sf_dir))


@query
def verify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


@query
def verify_rules_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream over the events file, read back from its sink."""
    path = scratch_path(spark, "verify-rules")
    truth = _truth(spark, sf_dir)
    stream = verify_stream(
        fx.body_stream(spark, sf_dir), fx.drawn_predictions, truth, path, scratch_path(spark, "progress"), availableNow=True
    )
    stream.awaitTermination()
    return spark.read.parquet(path)


@query
def verify_rules_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with ground truth read anew for every micro-batch."""
    path = scratch_path(spark, "verify-refreshed")
    stream = verify_stream_refreshed(
        fx.body_stream(spark, sf_dir),
        fx.drawn_predictions,
        lambda batch: _truth(spark, sf_dir),
        path,
        scratch_path(spark, "progress"),
        availableNow=True,
    )
    stream.awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


@query
def verify_rules_awaited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by requests that come before half of the forecasts do: answered at once, when their hour lands, or when it
    can no longer land in time."""
    requests_at, payloads_at, out, first, late = (scratch_path(spark, f"awaited-{n}") for n in ("r", "p", "out", "cp", "late"))
    begin = F.lit("2024-06-01 00:00:00").cast("timestamp")
    after = begin + F.expr("interval 2 days")
    landed_at = F.when(F.col("status") == 0, after).otherwise(begin + F.expr("interval 20 minutes"))

    def ask(clock) -> None:
        jobs.verify_landing_requests(
            spark, requests_at, payloads_at, "", out, first, wait=True, clock=clock, predict=fx.drawn_predictions, availableNow=True
        ).awaitTermination()

    def answer() -> None:
        jobs.verify_waiting_requests(
            spark, payloads_at, "", out, late, "1 hour", "10 minutes", landed_at, fx.drawn_predictions, availableNow=True
        ).awaitTermination()

    documents = fx.payloads(spark, sf_dir)
    early = F.pmod(F.xxhash64("city", "issued"), F.lit(2)) == 0
    fx.request_lines(fx.events(spark, sf_dir)).write.text(requests_at)
    documents.where(early).write.json(payloads_at)
    ask(begin)
    documents.where(~early).write.mode("append").json(payloads_at)
    answer()
    # Two days on; a request without a date is none, and a document without hours brings none.
    spark.sql("""SELECT '{"date": ""}' AS value""").write.mode("append").text(requests_at)
    spark.sql("SELECT 0 AS status").write.mode("append").json(payloads_at)
    ask(after)
    answer()
    return spark.read.parquet(f"{out}/results").unionByName(spark.read.parquet(f"{out}/late_results")).drop("batch_id")


@query
def requests_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no requests, with the reason; and the number of lines that are."""
    path = scratch_path(spark, "damaged-requests")
    fx.damaged_request_lines(fx.events(spark, sf_dir)).write.text(path)
    lines = requests.read_bodies(spark, path)
    sound = requests.sound_bodies(lines).agg(F.lit(None).cast("string").alias("body"), F.concat(F.count("*"), F.lit(" sound")).alias("reason"))
    return requests.damaged_bodies(lines).select("body", "reason").unionByName(sound)


@query
def observations_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a CSV folder that are no observations, with the reason; and the ids of those that are."""
    path = scratch_path(spark, "damaged-observations")
    lines = fx.damaged_observation_lines(fx.observations(spark, sf_dir))
    lines.write.option("header", True).option("quote", "").option("escapeQuotes", False).option("delimiter", "\u0001").csv(path)
    good, bad = tables.split_observations_csv(spark, path)
    sound = good.select(F.col("id").cast("string").alias("record"), F.lit("sound").alias("reason"))
    return bad.select(F.split_part("record", F.lit(","), F.lit(1)).alias("record"), "reason").unionByName(sound)


# Aggregates and metrics


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.row_counts(fx.regimes(spark, sf_dir), "weather")


def _classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels table read as labels (quality) and predictions (toxic)."""
    label, prediction = F.col("quality"), F.col("toxic")
    return spark.read.parquet(f"{sf_dir}/labels.parquet").agg(
        F.round(metrics.accuracy(label, prediction), 9).alias("extreme__accuracy"),
        F.round(metrics.precision(label, prediction), 9).alias("extreme__precision"),
    )


def _regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a fixed linear prediction from the hour."""
    rows = train.calendar_features(fx.observations(spark, sf_dir))
    return rows.agg(
        *[
            F.round(metrics.mean_absolute_error(F.col(t), F.col("hour") * 0.25 + 10 * i), 6).alias(f"{t}__mae")
            for i, t in enumerate(TARGETS, 1)
        ]
    )


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _classification(spark, sf_dir)
    return metrics.as_rows(scores, scores.columns)


@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _regression(spark, sf_dir)
    return metrics.as_rows(scores, scores.columns)


@query
def metric_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = classification_metrics(spark, sf_dir).unionByName(regression_metrics(spark, sf_dir))
    return metrics.display_metrics(scores)


# Samples and splits


@query
def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows, to the row."""
    rows = fx.observations(spark, sf_dir)
    return sampling.sample_exact(rows, fx.ids(spark, sf_dir).count() // 3).select("id", "temp_celsius")


@query
def sample_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 10,000 rows, which keeps a smaller table whole."""
    return sampling.sample_exact(fx.observations(spark, sf_dir), 10_000).select("id", "temp_celsius")


@query
def split_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_bucket(fx.ids(spark, sf_dir))


@query
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_exact(fx.ids(spark, sf_dir))


@query
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head(fx.observations(spark, sf_dir))


# Sinks, each read back


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "observations-csv")
    tables.write_observations_csv(fx.observations(spark, sf_dir), path)
    return tables.read_observations_csv(spark, path)


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "observations")
    tables.write_observations(fx.observations(spark, sf_dir), path, "million")
    return tables.read_observations(spark, path, "million")


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "table")
    name = "observations_" + path.rsplit("-", 1)[1]
    tables.save_table(fx.observations(spark, sf_dir), name, path)
    return spark.table(name)


@query
def regime_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per sheet after the fan-out: all of them, and each type from its own folder."""
    path = scratch_path(spark, "regimes")
    tables.write_regimes(fx.regimes(spark, sf_dir), path)
    return metrics.row_counts(tables.read_regimes(spark, path), "weather").withColumnRenamed("weather", "sheet")


@query
def regime_fanout_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fan-out as CSV with units in the headers, every row read back."""
    path = scratch_path(spark, "regimes-csv")
    tables.write_regimes_csv(fx.regimes(spark, sf_dir), path)
    return tables.read_regimes_csv(spark, path)


# Models


@query
def training_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train.training_cells(train.training_rows(fx.observations(spark, sf_dir)))


@query
def training_cells_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the training rows, taken in from a folder to which files are added twice."""
    path = scratch_path(spark, "appended")
    store = CellStore(spark, scratch_path(spark, "cells"))
    rows = fx.observations(spark, sf_dir)
    for part in (0, 1):
        rows.where(F.col("id") % 3 == part if part else F.col("id") % 3 != 1).write.mode("append").parquet(path)
        store.take_in(path)
    return store.cells()


@query
def bootstrap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train.bootstrap_cells(train.training_rows(fx.observations(spark, sf_dir)), train.CLASSIFIER_TREES)


@query
def forest_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = trained(spark, sf_dir)
    return train.score(job.test, job.grid).select("id", "extreme", train.CLASS_PREDICTION)


@query
def forest_regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = trained(spark, sf_dir)
    return train.score(job.test, job.grid).select("id", *TARGETS, *map(train.predicted, TARGETS))


@query
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained(spark, sf_dir).metrics()


@query
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    predict = train.model_predictions(trained(spark, sf_dir).grid)
    columns = [f"ai_{t}" for t in (*TARGETS, "is_extreme_weather")]
    return predict(_valid(spark, sf_dir)).select("id", "city", "hour_key", *columns)


@query
def verify_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    predict = train.model_predictions(trained(spark, sf_dir).grid)
    return verify.verify(fx.bodies(spark, sf_dir), predict, _truth(spark, sf_dir))


@query
def verify_stream_(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "verify")
    predict = train.model_predictions(trained(spark, sf_dir).grid)
    truth = _truth(spark, sf_dir)
    stream = verify_stream(
        fx.body_stream(spark, sf_dir), predict, truth, path, scratch_path(spark, "progress"), availableNow=True
    )
    stream.awaitTermination()
    return spark.read.parquet(path)


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last requested hour of every mapped city."""
    return _valid(spark, sf_dir).groupBy("city").agg(F.max("hour_at").alias("start_at"))


@query
def timeline_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.timeline_hours(_starts(spark, sf_dir))


@query
def forecast_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.forecast_timeline(_starts(spark, sf_dir), trained(spark, sf_dir).grid)
