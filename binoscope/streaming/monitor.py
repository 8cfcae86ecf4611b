"""Scheduled scoring and drift checks with Structured Streaming.

Nothing is computed here that the batch operators do not compute: a fitted pipeline is a projection and works on
a stream as it is, and each micro-batch is checked with the drift report against the stored profile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binoscope.operators.drift import drift_report
from binoscope.operators.models import Features, FittedModel, score_batch


def score_stream(records: DataFrame, model: FittedModel, threshold: float, run_id: str, features: Features,
                 keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Streaming form of batch scoring; stateless, so it needs no watermark."""
    return score_batch(records, model, threshold, run_id, features, list(keep))


def drift_per_batch(records: DataFrame, profile: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append one drift report per micro-batch to `path`; replayed batches write the same batch_id partition again."""
    def check(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            drift_report(batch, profile).withColumn("checked_rows", F.lit(batch.count())).write.mode("overwrite").parquet(
                f"{path}/batch_id={batch_id}")

    writer = records.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
