"""Incremental outcome scoring (M2-M4) as a Structured Streaming job.

The reference scores pending predictions once a day in batch; here each new
batch of price files triggers the same pending-prediction query over all stored
predictions. Because scoring anti-joins the outcomes already written, a batch
that is replayed after a failure writes nothing twice (the checkpoint plus the
anti-join give effectively-once output without a transactional sink).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import outcomes as out

OUTCOME_ID = T.StructType([T.StructField("prediction_id", T.LongType())])


def _existing_ids(spark: SparkSession, outcomes_path: str) -> DataFrame:
    """Ids scored so far; none while the folder does not exist. Any other failure is raised, since
    taking it for an empty folder would score and append everything again."""
    try:
        return spark.read.parquet(outcomes_path).select("prediction_id")
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], OUTCOME_ID)


def score_batch(spark: SparkSession, predictions: DataFrame, bars_path: str, outcomes_path: str,
                trained_at: str | None = None, version: str | None = None) -> int:
    """One micro-batch: every stored prediction with a realised price and no
    outcome yet is scored and appended, partitioned by date."""
    bars = spark.read.parquet(bars_path)
    pending = out.pending_predictions(predictions, out.realized_prices(bars), _existing_ids(spark, outcomes_path))
    scored = out.score_outcomes(pending, trained_at, version).persist()
    n = scored.count()
    if n:
        scored.write.mode("append").partitionBy("trading_date").parquet(outcomes_path)
    scored.unpersist()
    return n


def start(spark: SparkSession, bars_path: str, bars_schema: T.StructType, predictions: DataFrame,
          outcomes_path: str, checkpoint_location: str, available_now: bool = True,
          trained_at: str | None = None, version: str | None = None):
    """Start the stream: new files under ``bars_path`` trigger a scoring batch."""
    prices = spark.readStream.schema(bars_schema).parquet(bars_path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        score_batch(batch.sparkSession, predictions, bars_path, outcomes_path, trained_at, version)

    writer = prices.select(F.lit(1).alias("tick")).writeStream.foreachBatch(on_batch) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
