"""Drift of batches as they arrive: the batch monitor fed by a stream instead of a list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retentia.operators.drift import DriftRule, drift_summary
from retentia.operators.drift_many import many_drift, reference_counts


def monitor_stream(
    stream: DataFrame, reference: DataFrame, output: str, checkpoint: str, rule: DriftRule = DriftRule(), *, skip: Sequence[str] = ()
) -> StreamingQuery:
    """Compare every micro-batch with the reference and write its summary row to ``output``.

    The reference is counted once, when the monitor starts; a micro-batch reads the stored counts.
    A micro-batch overwrites its own partition, so running one again after a failure leaves one row.
    The written summary is what the retrain decision reads, ordered by ``batch_id``.
    """

    counted = reference_counts(reference, skip=skip)

    def measure(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        detail = many_drift(counted, batch, F.lit(f"batch_{batch_id:06d}"), rule)
        drift_summary(detail, rule).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(measure).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_summary(spark, output: str) -> DataFrame:
    return spark.read.parquet(output).withColumn("batch_id", F.col("batch_id").cast("bigint"))
