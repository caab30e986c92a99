"""Storage of the variant ledger: ``<path>/run=<id>``, one folder of added rows per run, and a manifest of its files.

A run's files hold disjoint ranges of (place of the root, root, id), where a root's place is a hash of it, so that a root with very many
ids has several files. The manifest lists the places in each file, a Bloom filter with one hash function kept as the list of its
set bits: a run over few roots opens the files that hold their places, however many runs came before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.session import shared_folder
from catalogflow.sources import files

PLACES = 1 << 16
FILE_BYTES = 64 << 20  # of a file, about
SCHEMA = "root_id string, variant_id string"
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "file string, places array<int>, n long"


def place(root: Column) -> Column:
    """Place of a root in the order of the files and in their filters."""
    return F.pmod(F.xxhash64(root), F.lit(PLACES)).cast("int")


def read_ledger(spark: SparkSession, path: str, skip_run: str | None = None, roots: DataFrame | None = None) -> DataFrame:
    """Ledger rows; an absent ledger is empty. ``skip_run`` hides what an earlier attempt of the run wrote.

    With ``roots(root_id)`` only the files that may hold one of them are read; a run without a manifest is read whole.
    """
    runs = [n for n in files.folders(spark, path) if n.startswith("run=") and n != f"run={skip_run}"]
    known = [n for n in runs if files.exists(spark, f"{path}/{MANIFEST}/{n}/_SUCCESS")]
    if roots is None or not known:
        chosen = [f"{path}/{n}" for n in runs]
    else:
        wanted = roots.select(place(F.col("root_id")).alias("place")).distinct()
        held = spark.read.schema(MANIFEST_SCHEMA).parquet(*[f"{path}/{MANIFEST}/{n}" for n in known])
        opened = held.select("file", F.explode("places").alias("place")).join(wanted, "place", "left_semi").select("file").distinct()
        chosen = [r["file"] for r in opened.collect()] + [f"{path}/{n}" for n in runs if n not in known]  # the files to open
    if not chosen:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(*chosen).select("root_id", "variant_id")


def append_ledger(added: DataFrame, path: str, run: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the rows a run adds. Repeating the run replaces its own folder and nothing else.

    The rows are written once as they come, which tells their size; there are as many ranges as files of ``file_bytes`` hold them.
    """
    spark = added.sparkSession
    draft = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    added.select("root_id", "variant_id").write.parquet(draft)
    ranges = max(1, -(-files.size(spark, draft) // file_bytes))
    order = [place(F.col("root_id")), F.col("root_id"), F.col("variant_id")]
    rows = spark.read.schema(SCHEMA).parquet(draft)
    files.remove(spark, f"{path}/{MANIFEST}/run={run}")
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/run={run}")
    files.remove(spark, draft)
    written = spark.read.schema(SCHEMA).parquet(f"{path}/run={run}")
    manifest = written.groupBy(files.decoded(F.col("_metadata.file_path")).alias("file")).agg(
        F.array_sort(F.collect_set(place(F.col("root_id")))).alias("places"), F.count("*").alias("n"))  # at most PLACES a file
    manifest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{MANIFEST}/run={run}")


def compact(ledger: DataFrame, new_path: str, run: str) -> None:
    """Write a whole ledger to a new place as one run."""
    append_ledger(ledger, new_path, run)


def import_json(documents: DataFrame, column: str = "value") -> DataFrame:
    """Ledger rows of the older form, a JSON map from root id to its list of ids, one document per row."""
    parsed = F.from_json(column, "map<string,array<string>>")
    roots = documents.select(F.explode(parsed).alias("root_id", "ids"))
    return roots.select("root_id", F.explode("ids").alias("variant_id")).distinct()
