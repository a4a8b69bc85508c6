"""Session helpers.

The library never creates a session on its own inside operators; these helpers
are for tests, the bench and command-line use. On a cluster the caller's
session is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "barloom") -> SparkSession:
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def plan_session(spark: SparkSession) -> SparkSession:
    """Settings the feature plans are designed for: joins on (ticker, date)
    may reuse a partitioning by ticker alone, so the buckets of the stored tables
    serve joins and windows. Applied by the pipeline entry points."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # a bucket is one sorted file (see ``stored``): scans of bucketed tables keep that order
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (HDFS/S3/...) folder and is used
    as is; without it nothing can be stored there and an error says so. Only a
    local master, whose tasks share the driver's disk, gets a scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="barloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def stored(df: DataFrame, name: str, bucket_by: str | None = None, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, so that
    later plans scan only the columns and row groups they need, and a lost
    executor takes nothing with it. A column without a type is kept as text.

    With ``bucket_by`` the rows are dealt into one sorted file per bucket (as many
    as there are shuffle partitions) under a table name of this session: joins,
    windows and groups by that column then need no exchange, and with ``sort_by``
    no sort either."""
    spark = df.sparkSession
    df = df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if f.dataType.typeName() == "void"
                     else F.col(f"`{f.name}`") for f in df.schema.fields])
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if bucket_by:
        n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), "barloom_" + uuid.uuid4().hex
        (df.repartition(n, bucket_by).write.format("parquet").option("path", path)
         .bucketBy(n, bucket_by).sortBy(bucket_by, *sort_by).saveAsTable(table))
        return spark.table(table)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
