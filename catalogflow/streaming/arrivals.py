"""Process pages as they arrive, with the functions of a batch run.

Each micro-batch of fetched pages is extracted and matched like a batch run. A catalogue whose unhandled errors, counted over all
batches so far, exceed its limit is stopped: later batches write nothing of it. Statuses, ledger and report need the whole run
and are derived from the written pages.

The count of each catalogue is kept as one small table a batch rather than in a keyed state store: a stateful operator would need the
extraction as a second branch of the plan and switch off adaptive execution, by which a hot page is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogflow.operators import outcome
from catalogflow.operators.joins import join_reduced
from catalogflow.plans.profile import SiteProfile
from catalogflow.plans.site_run import limited, prepared, processed
from catalogflow.sources import files

ERRORS = "_errors"  # hidden from readers of the pages


def start(profile: SiteProfile, catalog: DataFrame, fetched: DataFrame, out: str, checkpoint: str,
          trigger: dict | None = None) -> StreamingQuery:
    """Write the processed pages of a stream to ``<out>/batch=<id>``, without those of catalogues that were stopped before.

    A repeated batch id overwrites its own folders and counts from those of the batch before, so a restart neither loses nor
    repeats pages or errors. The batch in which a catalogue meets its limit is written whole; :func:`finish` cuts it.
    """
    listed = prepared(profile, catalog)
    counts = f"catalog_id {listed.schema['catalog_id'].dataType.simpleString()}, errors bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = errors_before(spark, out, batch_id, counts)
        stopped = before.where(F.col("errors") > profile.max_errors).select("catalog_id")
        rows = join_reduced(processed(profile, listed, batch), stopped, ["catalog_id"], "left_anti")
        _write(rows, f"{out}/batch={batch_id}")
        new = _counted(spark.read.schema(rows.schema).parquet(f"{out}/batch={batch_id}"))
        _write(before.unionByName(new).groupBy("catalog_id").agg(F.sum("errors").alias("errors")), f"{out}/{ERRORS}/batch={batch_id}")
        files.remove(spark, f"{out}/{ERRORS}/batch={batch_id - 2}")  # a repeat of this batch needs only the one before it

    writer = fetched.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def errors_before(spark: SparkSession, out: str, batch_id: int, schema: str) -> DataFrame:
    """``(catalog_id, errors)`` over the batches before one; counted from their pages where the table is missing."""
    path = f"{out}/{ERRORS}/batch={batch_id - 1}"
    if files.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    earlier = [f for f in files.folders(spark, out) if f.startswith("batch=") and int(f.partition("=")[2]) < batch_id]
    if not earlier:
        return spark.createDataFrame([], schema)
    return _counted(spark.read.parquet(*[f"{out}/{f}" for f in earlier]))


def _counted(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("code") == outcome.UNHANDLED).groupBy("catalog_id").agg(F.count("*").alias("errors"))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def finish(profile: SiteProfile, spark: SparkSession, out: str, label: str) -> DataFrame:
    """Pages of all batches up to the error cut-off, as :class:`catalogflow.plans.site_run.RunTables` expects them."""
    return limited(profile, spark.read.parquet(out).drop("batch"), label)
