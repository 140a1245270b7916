"""The jobs as commands run them: from landed files to landed files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wxspark.constants import ROWS_PER_REGIME
from wxspark.operators import sampling
from wxspark.operators.joins import BROADCAST_ROWS
from wxspark.operators.metrics import display_metrics
from wxspark.plans import timeline, train, verify
from wxspark.plans.cell_store import CellStore
from wxspark.plans.registry import Registry
from wxspark.schemas import PAYLOAD_FILE, WAITING
from wxspark.session import scratch_path
from wxspark.sources import generate, payloads, requests, tables
from wxspark.sources.truth_store import TruthStore
from wxspark.sources.versions import Versions
from wxspark.streaming import awaited
from wxspark.streaming.verify_stream import for_each_batch

# Ids per task when regimes are generated; a task writes one file per weather type.
_REGIME_IDS_PER_TASK = 1_000_000


def generate_observations(
    spark: SparkSession, scale: str, out: str, form: str = "csv", anchor: datetime | None = None, table: str | None = None
) -> None:
    """A scale preset to CSV (folder named after the scale), to parquet (partition of that name), or to a table."""
    rows = generate.observations(generate.scale_ids(spark, scale), anchor)
    if table:
        tables.save_table(rows, table)
    elif form == "csv":
        tables.write_observations_csv(rows, f"{out}/observations_{scale}.csv")
    else:
        tables.write_observations(rows, out, scale)


def preview_observations(spark: SparkSession, anchor: datetime, rows: int = 5) -> DataFrame:
    """The first rows of any scale. Draws depend on the id alone, so the table need not be read for them."""
    return sampling.head(generate.observations(generate.id_range(spark, rows, 1), anchor), rows)


def generate_regimes(spark: SparkSession, out: str, rows_per_type: int = ROWS_PER_REGIME, form: str = "parquet") -> None:
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows_per_type // _REGIME_IDS_PER_TASK))
    rows = generate.regimes(generate.id_range(spark, rows_per_type, tasks), rows_per_type)
    (tables.write_regimes if form == "parquet" else tables.write_regimes_csv)(rows, out)


def read_any_observations(spark: SparkSession, path: str, scale: str | None = None) -> DataFrame:
    """Observations from a CSV folder or, by default, a parquet one.

    Ids repeat between scales, so a parquet folder of several needs one named.
    """
    if path.rstrip("/").endswith(".csv"):
        return tables.read_observations_csv(spark, path)
    rows = tables.read_observations(spark, path, scale)
    if "target_scale" in rows.columns:
        found = [r[0] for r in rows.select("target_scale").distinct().limit(2).collect()]
        if len(found) > 1:
            raise ValueError(f"{path} has several scales; name one")
        rows = rows.drop("target_scale")
    return rows


def train_models(
    spark: SparkSession,
    observations: str,
    out: str,
    cap: int | None = None,
    exact_split: bool = False,
    scale: str | None = None,
    replicates: int = train.REPLICATES,
    bootstrap: str = "replicates",
) -> DataFrame:
    """Fit, evaluate and publish a new version of the models under ``out``."""
    job = train.train(
        read_any_observations(spark, observations, scale), cap, exact_split, replicates=replicates, bootstrap=bootstrap
    )
    registry = Registry(spark, out)
    return display_metrics(registry.metrics(registry.publish(job)))


def train_appended(spark: SparkSession, observations: str, store: str, out: str) -> DataFrame:
    """The same from observations that keep being added to a folder: only files that are new are read.

    ``observations`` is a folder of parquet files or, if it ends in .csv, of CSV files.
    """
    cells = CellStore(spark, store)
    cells.take_in(observations)
    registry = Registry(spark, out)
    return display_metrics(registry.metrics(registry.publish(cells.train())))


def land_truth(spark: SparkSession, landed_payloads: str, path: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ground truth of the landed payload documents, stored so that counting and joining it do not rebuild it.

    Beyond the broadcast bound it becomes a table in buckets of city and hour, so that the lookup's join does not shuffle it.
    """
    documents = payloads.read_payloads(spark, landed_payloads)
    payloads.ground_truth(payloads.payload_hours(documents)).write.mode("overwrite").parquet(path)
    truth = spark.read.parquet(path)
    if truth.count() <= broadcast_rows:
        return truth
    name = "truth_" + path.rsplit("-", 1)[-1]
    tables.save_table(truth, name, f"{path}-buckets", by=("city", "hour_at"))
    return spark.table(name)


def land_new_hours(spark: SparkSession, landed_payloads: str, store: str) -> TruthStore:
    """Merge the documents that landed since the last call into the ground truth under ``store``.

    Which files have been taken is kept by the stream's own progress there. Merging a document twice changes nothing, so
    a call that was cut off is made good by the next.
    """
    truth = TruthStore(spark, store)

    def merge(documents: DataFrame, _batch_id: int) -> None:
        truth.merge(payloads.payload_hours(documents))

    landed = spark.readStream.schema(PAYLOAD_FILE).json(landed_payloads)
    for_each_batch(landed, merge, f"{store}/progress", availableNow=True).awaitTermination()
    return truth


def truth_for(truth: TruthStore, batch: DataFrame, now: datetime | None = None) -> DataFrame:
    """Ground truth of the days that the requests of ``batch`` ask for; other days are not read."""
    asked = requests.parse_requests(batch)
    checked = requests.validate_requests(asked if now is None else requests.default_requests(asked, now))
    days = verify.with_request_time(checked).select(F.col("hour_at").cast("date").alias("day"))
    return truth.read(days.where(F.col("day").isNotNull()))


def verify_requests(
    spark: SparkSession, landed_requests: str, landed_payloads: str, models: str, out: str, now: datetime | None = None
) -> None:
    """Landed request bodies to a results table (``results``), responses with their ids (``responses``, JSON lines), and
    bodies that are none (``quarantine``)."""
    lines = requests.read_bodies(spark, landed_requests)
    requests.damaged_bodies(lines).write.parquet(f"{out}/quarantine")
    bodies = requests.sound_bodies(lines)
    truth = land_truth(spark, landed_payloads, scratch_path(spark, "truth"))
    results = verify.verify(bodies, Registry(spark, models).predictor(), truth, also=("model_version",), now=now)
    _write_answers(results, out, "results", "responses")


def _write_answers(results: DataFrame, out: str, table: str, texts: str, batch_id: int | None = None) -> None:
    at = "" if batch_id is None else f"/batch_id={batch_id}"
    mode = "errorifexists" if batch_id is None else "overwrite"
    results.write.mode(mode).parquet(f"{out}/{table}{at}")
    stored = results.sparkSession.read.schema(results.schema).parquet(f"{out}/{table}{at}")
    verify.result_json(stored).write.mode(mode).json(f"{out}/{texts}{at}")


def verify_landing_requests(
    spark: SparkSession,
    landing: str,
    landed_payloads: str,
    models: str,
    out: str,
    checkpoint: str,
    max_files: int = 10_000,
    wait: bool = False,
    fill_defaults: bool = False,
    clock: Column | None = None,
    predict: verify.Predictor | None = None,
    **trigger,
) -> StreamingQuery:
    """The same for files that keep landing in a folder. Payloads that landed meanwhile are merged before each
    micro-batch, which then reads the hours of its own days only, under ``checkpoint``; it predicts with the models that are
    current then.

    A backlog is taken ``max_files`` at a time. With ``wait``, requests whose hour is not known are not answered but
    put into ``waiting``, from where ``verify_waiting_requests`` takes them; ``clock`` says since when they wait (now, by
    default). A batch that is run again after a failure leaves those waiting that it has put there, as they may have been
    answered. With ``fill_defaults``, absent dates and cities are filled in at the time of the batch. ``predict`` takes the
    place of the models.
    """
    lines = requests.read_bodies(spark.readStream.option("maxFilesPerTrigger", max_files), landing)
    predict, also = (predict, ()) if predict else (Registry(spark, models).predictor(), ("model_version",))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        requests.damaged_bodies(batch).write.mode("overwrite").parquet(f"{out}/quarantine/batch_id={batch_id}")
        bodies = requests.sound_bodies(batch)
        now = datetime.now() if fill_defaults else None
        truth = truth_for(land_new_hours(spark, landed_payloads, f"{checkpoint}/truth"), bodies, now)
        results = verify.verify(bodies, predict, truth, also=also, now=now)
        if wait:
            results = _answered(results, out, batch_id, F.current_timestamp() if clock is None else clock)
        _write_answers(results, out, "results", "responses", batch_id)

    return for_each_batch(lines, write_batch, checkpoint, **trigger)


def _answered(results: DataFrame, out: str, batch_id: int, clock: Column) -> DataFrame:
    """The results of a batch without those of requests that wait, which are written."""
    spark = results.sparkSession
    path = scratch_path(spark, "batch-results")
    awaited.tickets(results, batch_id).write.parquet(path)
    ticketed = spark.read.parquet(path)
    folder, written = f"{out}/waiting/batch_id={batch_id}", Versions(spark, f"{out}/waiting-batches")
    if batch_id + 1 not in written.numbers():
        awaited.waiting_rows(ticketed, clock).write.mode("overwrite").parquet(folder)
        written.commit(batch_id + 1)
    waiting = spark.read.schema(WAITING).parquet(folder).select("ticket")
    return ticketed.join(waiting, "ticket", "left_anti").select(*results.columns)


def verify_waiting_requests(
    spark: SparkSession,
    landed_payloads: str,
    models: str,
    out: str,
    checkpoint: str,
    wait: str = "6 hours",
    lateness: str = "10 minutes",
    landed_at: Column | None = None,
    predict: verify.Predictor | None = None,
    **trigger,
) -> StreamingQuery:
    """Answer the requests that ``verify_landing_requests`` left waiting under ``out``, each once: when its hour lands or,
    as not found, when it can no longer land in time. Answers go to ``late_results`` and ``late_responses``.

    A forecast lands when its file is written; ``landed_at`` may name another column of its."""
    predict, also = (predict, ()) if predict else (Registry(spark, models).predictor(), ("model_version",))

    def answer(bodies: DataFrame, batch_id: int) -> None:
        truth = truth_for(land_new_hours(spark, landed_payloads, f"{checkpoint}/truth"), bodies)
        results = verify.verify(bodies, predict, truth, also=also)
        _write_answers(results, out, "late_results", "late_responses", batch_id)

    waiting = awaited.read_waiting(spark, f"{out}/waiting")
    hours = awaited.landing_hours(spark, landed_payloads, lateness, landed_at)
    return awaited.answer_waiting(waiting, hours, answer, checkpoint, wait, lateness, **trigger)


def forecast(spark: SparkSession, models: str, start: datetime, out: str) -> None:
    """Seven days of hourly predictions for each city from the given hour on."""
    from wxspark.sources.dims import city_dim

    starts = city_dim(spark).select("city", F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz").alias("start_at"))
    timeline.forecast_timeline(starts, Registry(spark, models).grid()).write.parquet(out)
