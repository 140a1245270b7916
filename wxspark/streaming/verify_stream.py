"""Verify a stream of request bodies with the same plan as the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wxspark.plans.verify import Predictor, verify


def verify_stream(
    bodies: DataFrame,
    predict: Predictor,
    truth: DataFrame,
    path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Append results to parquet. Stateless stream-static joins: no watermark, exactly once per file.

    ``trigger`` goes to ``DataStreamWriter.trigger``; by default the query runs until stopped.
    """
    writer = (
        verify(bodies, predict, truth)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def verify_stream_refreshed(
    bodies: DataFrame,
    predict: Predictor,
    read_truth,
    path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """The same for ground truth that changes: ``read_truth`` gives it, and its size is checked, for every micro-batch.

    A batch that is retried after a failure overwrites its own folder ``batch_id=<n>``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        results = verify(batch, predict, read_truth(batch))
        results.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return for_each_batch(bodies, write_batch, checkpoint, **trigger)


def for_each_batch(bodies: DataFrame, write_batch, checkpoint: str, **trigger) -> StreamingQuery:
    writer = bodies.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
