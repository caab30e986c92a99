"""The registered queries of the dealt operators: each over its whole table, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.llm import (
    bytebpe, digests, infill, licenses, mixing, neardup, nearest, packing, personal, quality, secrets, toxicity, whitening,
)
from catalogflow.llm.common import table


def word_tokenizer() -> str:
    """Where the public tokenizer of the packing query lies; only its path is a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's block, the slot of that block in the mixture, and its place in the block."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return mixing.mix(docs).drop("n_chars")


def op2_pack_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document in a sequence, with a checksum of its ids."""
    pieces = packing.pack(table(spark, folder, "documents"), word_tokenizer(), lower_words=True)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_scan_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every text."""
    docs = table(spark, folder, "documents")
    return secrets.digest_columns(secrets.scan(docs, secrets.fit(docs)), secrets.KINDS[:3])


def op4_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every text."""
    docs = table(spark, folder, "documents")
    return secrets.digest_columns(personal.scan(docs, personal.fit(docs)), personal.KINDS, "base")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of linked texts of every document."""
    return neardup.groups(table(spark, folder, "documents"))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in every text."""
    return licenses.scan(table(spark, folder, "documents"))


def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every query vector."""
    return nearest.search(table(spark, folder, "embeddings"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text."""
    docs = table(spark, folder, "documents")
    return quality.held(quality.score(docs, quality.fit(docs, table(spark, folder, "labels"))))


def op10_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and its edited form."""
    return digests.fingerprints(table(spark, folder, "documents"))


def op11_whiten(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the leading components of all vectors, each with unit variance."""
    vectors = table(spark, folder, "embeddings")
    model = whitening.fit(vectors)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = whitening.whiten(vectors, model).select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("i", "whitened"))
    explained = F.array(*[F.lit(float(x)) for x in model.explained])
    return rows.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.at.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("i")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, lengths and digests of every document's fill-in-middle output and of the text restored from it."""
    return infill.digests(table(spark, folder, "documents"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of every text's ids, and the digest of the bytes decoded from them."""
    import public_tokenizers

    return bytebpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_pack_tiers, op3_scan_secrets, op4_personal, op5_toxicity, op6_near_duplicates, op7_licenses, op8_nearest, op9_quality,
        op10_fingerprint, op11_whiten, op12_fill_in_middle, op13_byte_bpe)
}
ORACLE: dict[str, str] = {}
