"""What the operators share: Arrow batches of bounded size, whole texts, words, and bounded labelled samples."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.session import shared_folder

WORD = re.compile(r"\w+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds: Python workers see a few MB of text at once, and one row if it is longer."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4194304")


def by_batch(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``f`` to each Arrow batch, without a shuffle."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := f(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def words(text: str) -> list[str]:
    """Lower-case words of a text."""
    return WORD.findall(text.lower())


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to a new folder in the shared place and read back, so that a lost executor repeats no earlier work."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, rows: int, chars: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled ids that are not held out, with texts of at most ``chars`` characters.

    The ids are drawn from the labels alone (smallest hashes first), so that only the drawn texts travel. A document
    with contradicting labels takes the smaller one. Held-out labels are never read past the filter.
    """
    drawn = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder(F.col("doc_id"), divisor) != held_out))
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    both = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # at most `rows` ids and labels
    return both.where(F.length("text") <= chars).select("doc_id", "text", "y")


def learning_texts(
    docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, rows: int, chars: int,
) -> tuple[list[str], np.ndarray]:
    """Texts and labels of :func:`learning_rows`, in a stable order."""
    got = learning_rows(docs, labels, label, divisor, held_out, rows, chars).toArrow().to_pydict()
    order = sorted(range(len(got["y"])), key=lambda i: (got["doc_id"][i], got["text"][i]))
    return [got["text"][i] for i in order], np.array([got["y"][i] for i in order], dtype=np.float32)


def sample_texts(docs: DataFrame, rows: int, chars: int) -> list[str]:
    """At most ``rows`` texts of at most ``chars`` characters with the smallest hashed ids, in a stable order."""
    drawn = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    got = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").where(F.length("text") <= chars).toArrow().to_pydict()
    return [t for _, t in sorted(zip(got["doc_id"], got["text"], strict=True))]
