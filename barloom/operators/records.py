"""Run records (A12): one row per training run in an append-only, versioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

c_ = F.col
CALIBRATION = "sigmoid (Platt scaling)"
TARGET = "5-day price direction (Up/Down)"


def training_record(rows: DataFrame, results: DataFrame, features: Sequence[str], trained_at: str, dead_zone_pct: float,
                    threshold: float, days_back: int | None = None, tuned: dict | None = None) -> DataFrame:
    """The record of one run.

    ``rows``: the labelled rows with trading_date, split (NULL: purged) and next_5d_return before the dead
    zone is taken out; ``results``: a row per model with model, accuracy and f1_weighted. The best model has
    the highest weighted F1, of equal ones the least name. Splits without rows are left out."""
    inside = F.abs("next_5d_return") < dead_zone_pct
    ranges = rows.where("split IS NOT NULL").groupBy("split").agg(
        F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(inside & (c_("split") != "test")).alias("n_dropped"))
    splits = ranges.agg(F.sort_array(F.collect_list(F.struct("split", "first_date", "last_date", "n_rows", "n_dropped"))).alias("splits"))
    # a row per split and per model
    models = results.agg(F.sort_array(F.collect_list(F.struct("model", "accuracy", "f1_weighted"))).alias("models"),
                         F.min(F.struct((-F.floor(c_("f1_weighted") * 1e9 + 0.5)).alias("o"), "model"))["model"].alias("best_model"))
    fixed = rows.sparkSession.range(1).select(
        F.lit(trained_at).cast("timestamp_ntz").alias("trained_at"), F.lit(TARGET).alias("target"),
        F.lit(CALIBRATION).alias("calibration_method"), F.array(*[F.lit(f) for f in features]).cast("array<string>").alias("features"),
        F.lit(dead_zone_pct).cast("double").alias("dead_zone_pct"), F.lit(threshold).cast("double").alias("decision_threshold"),
        F.lit(days_back).cast("int").alias("days_back"),
        F.create_map(*[F.lit(str(x)) for pair in sorted((tuned or {}).items()) for x in pair]).cast("map<string,string>").alias("tuned"))
    one = F.lit(1).alias("_one")        # three one-row tables
    return (fixed.withColumn("_one", one).join(splits.withColumn("_one", one), "_one")
            .join(models.withColumn("_one", one), "_one").drop("_one"))


def records(spark: SparkSession, path: str) -> DataFrame | None:
    """All records of a table, or None if nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_record(record: DataFrame, path: str) -> int:
    """Append a run's record with the next version (runs are written one at a time); returns the version."""
    before = records(record.sparkSession, path)
    version = 1 if before is None else (before.agg(F.max("version")).first()[0] or 0) + 1
    record.withColumn("version", F.lit(version)).coalesce(1).write.mode("append").parquet(path)
    return version


def latest_record(spark: SparkSession, path: str) -> DataFrame:
    """The newest run's row."""
    every = records(spark, path)
    if every is None:
        raise FileNotFoundError(path)
    return every.where(c_("version") == every.select(F.max("version")).scalar())
