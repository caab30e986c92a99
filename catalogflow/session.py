"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed for. Broadcast joins stay with Spark's own size check
# (autoBroadcastJoinThreshold on run-time statistics); skewed joins are split at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def builder(app: str = "catalogflow", **extra: str):
    """A SparkSession builder with the library's settings; ``extra`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        b = b.config(key, value)
    return b


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a missing setting is an error.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="catalogflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several outputs are derived from one expensive result, such as extracted items. The
    written table survives lost executors, and re-running the job overwrites it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`staged` under a name of its own, and the bytes written."""
    from catalogflow.sources import files

    own = f"{name}-{uuid.uuid4().hex}"
    rows = staged(df, own)
    return rows, files.size(df.sparkSession, f"{shared_folder(df.sparkSession)}/{own}")
