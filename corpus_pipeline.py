"""The corpus pipeline: quality, near duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and all but the last return the columns of
documents. The mixture has no column to carry its order: the stage writes its rows in order, and packing reads the order
back from the files' numbers and row numbers. Each pool that it packs is a stretch of that order and carries its place (``pool_file``,
``pool_row``), by which sequences are read in the order of the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.llm import mixing, neardup, packing, personal, quality
from catalogflow.llm.common import staged, table
from catalogflow.llm.queries import word_tokenizer

KEEP = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches ``KEEP``."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=True).where(F.col("quality_score") >= KEEP).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.kept(docs)


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data masked."""
    return personal.masked(docs, personal.fit(docs))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixture."""
    mixed = mixing.mix(docs)
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences, packed from stretches of the mixture."""
    file = F.regexp_extract("_metadata.file_name", "^part-([0-9]+)", 1).try_cast("long")
    rows = docs.select("doc_id", "text", F.coalesce(file, F.lit(0)).alias("file"), F.col("_metadata.row_index").alias("row"))
    return packing.pack(rows, word_tokenizer(), place=("file", "row"), lower_words=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_stage),
    ("mixture", mixture_stage),
    ("packing", packing_stage),
]

# Trained networks and a tokenizer: SQL cannot express them; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
