"""Typed scans and sinks (2.1).

Sinks write to paths under the shared checkpoint folder unless a path is
given; partitioned writes use dynamic partition overwrite so a rerun replaces
only the dates it covers (the reference's delete-then-insert per date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.columns import nan_to_null

c_ = F.col
PRICE_COLUMNS = ("open_price", "high_price", "low_price", "close_price")


def typed_bars(raw: DataFrame) -> DataFrame:
    """A1: prices stored as text become doubles (``try_cast``: bad text gives
    NULL instead of failing under ANSI; NaN and infinities are NULL too), volume
    becomes bigint."""
    cols = []
    for f in raw.columns:
        if f in PRICE_COLUMNS:
            cols.append(nan_to_null(F.expr(f"try_cast({f} AS DOUBLE)")).alias(f))
        elif f == "volume":
            cols.append(F.expr("try_cast(volume AS BIGINT)").alias("volume"))
        else:
            cols.append(c_(f))
    return raw.select(*cols)


def valid_bars(bars: DataFrame, price_floor: float = 5.0) -> DataFrame:
    """B2: finite close at or above the floor, positive volume."""
    return bars.filter((nan_to_null("close_price") >= price_floor) & (c_("volume") > 0))


def date_window(df: DataFrame, asof: str, days_back: int, col: str = "trading_date") -> DataFrame:
    """B1: the last ``days_back`` days up to ``asof`` (a parameter, never the wall clock)."""
    d = F.lit(asof).cast("date")
    return df.filter((c_(col) >= F.date_sub(d, days_back)) & (c_(col) <= d))


def param_query(spark: SparkSession, sql: str, args: dict, **tables: DataFrame) -> DataFrame:
    """A2: parameterised SQL; values bind as typed literals (no string splicing)."""
    return spark.sql(sql, args=args, **tables)


def table_schema(df: DataFrame, name: str) -> DataFrame:
    """A3: a table's columns as rows, with the table's rows and the column's values, counted in one pass."""
    rows = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"), c_("n").alias("n_rows"),
                              c_(f"c{i}").alias("n_values")) for i, f in enumerate(df.schema.fields)])
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}")
                                                    for i, f in enumerate(df.schema.fields)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def ordered_projection(df: DataFrame, order: list[str]) -> DataFrame:
    """Project in a given order, skipping names the frame lacks."""
    return df.select(*[c for c in order if c in df.columns])


def append_partitioned(df: DataFrame, path: str, partition: str = "trading_date") -> None:
    """Append sink, partitioned by date. Rows are clustered by the
    partition column first, so each date is written by one task (one file per
    date, not one per task and date); a date holds at most the ticker universe."""
    df.repartition(partition).write.mode("append").partitionBy(partition).parquet(path)


def replace_dates(df: DataFrame, path: str, partition: str = "trading_date") -> None:
    """Replace-by-date upsert: only the partitions present in ``df`` are rewritten."""
    (df.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_one_row_json(df: DataFrame, path: str) -> None:
    """A one-row document (derived thresholds), written whole."""
    df.coalesce(1).write.mode("overwrite").json(path)


THRESHOLD_DOC = T.StructType([
    T.StructField("buy_min_confidence", T.DoubleType()),
    T.StructField("high_confidence_threshold", T.DoubleType()),
    T.StructField("sell_max_confidence", T.DoubleType()),
    T.StructField("sector_confidence_overrides", T.MapType(T.StringType(), T.DoubleType())),
])


def effective_thresholds(doc: DataFrame, defaults: dict) -> DataFrame:
    """A4: validated overrides over defaults (a missing or non-numeric value
    keeps the default)."""
    def pick(name: str) -> Column:
        return F.coalesce(c_(name).cast("double"), F.lit(defaults[name]))
    sect = F.coalesce(c_("sector_confidence_overrides"),
                      F.create_map(*[x for k, v in defaults["sector_confidence_overrides"].items()
                                     for x in (F.lit(k), F.lit(v))]))
    return doc.select(pick("buy_min_confidence").alias("buy_min_confidence"),
                      pick("high_confidence_threshold").alias("high_confidence_threshold"),
                      pick("sell_max_confidence").alias("sell_max_confidence"),
                      sect.alias("sector_confidence_overrides"))


REPORT_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("log_file", T.StringType()),
    T.StructField("data_status", T.StructType([
        T.StructField("connected", T.BooleanType()), T.StructField("age_days", T.IntegerType()),
        T.StructField("latest_date", T.StringType()), T.StructField("total_records", T.LongType())])),
    T.StructField("retraining", T.StructType([
        T.StructField("performed", T.BooleanType()), T.StructField("success", T.BooleanType()),
        T.StructField("duration_minutes", T.DoubleType()), T.StructField("reason", T.StringType())])),
    T.StructField("csv_exports", T.StructType([
        T.StructField("success", T.BooleanType()), T.StructField("files_created", T.ArrayType(T.StringType()))])),
    T.StructField("database_export", T.StructType([
        T.StructField("success", T.BooleanType()), T.StructField("records_inserted", T.LongType())])),
    T.StructField("live_accuracy", T.MapType(T.StringType(), T.StructType([
        T.StructField("window_trading_days", T.IntegerType()), T.StructField("n_predictions", T.LongType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("by_confidence", T.MapType(T.StringType(), T.StructType([
            T.StructField("n", T.LongType()), T.StructField("accuracy", T.DoubleType())]))),
        T.StructField("by_sector", T.MapType(T.StringType(), T.StructType([
            T.StructField("n", T.LongType()), T.StructField("accuracy", T.DoubleType())]))),
    ]))),
])


def read_reports(spark: SparkSession, path_glob: str, one_document_per_file: bool = False) -> DataFrame:
    """A5: every run report under a glob, with one explicit schema covering the
    three document shapes (absent sections read as NULL). Pretty-printed
    one-document files need ``one_document_per_file``; JSON lines do not."""
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", one_document_per_file).json(path_glob)
