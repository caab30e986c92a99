"""Document fingerprints: a digest of the quartiles of hashed byte-triplet counts, and the likeness of two digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalogflow.llm.common import small_batches, staged

BUCKETS = 128
PIECE = 1 << 20  # bytes counted at once
BOUND = 256  # a difference of this or more is likeness 0
_STEP = np.array([[abs(a - b) if abs(a - b) < 3 else 6 for b in range(4)] for a in range(4)])
# By byte of two digests: the difference of the four two-bit codes in it.
_BYTE_STEP = sum(_STEP[np.arange(256)[:, None] >> s & 3, np.arange(256)[None, :] >> s & 3] for s in (0, 2, 4, 6))

DIGEST_SCHEMA = "kind int, doc_id long, h long, text string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def triplet_counts(data: bytes) -> np.ndarray:
    """Counts of hashed byte triplets, adjacent and with a gap before the third byte."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(len(data) - 2, 0), PIECE):
        a = np.frombuffer(data, dtype=np.uint8, count=min(PIECE + 3, len(data) - at), offset=at).astype(np.uint32)
        n = min(PIECE, len(a) - 2)
        pair = a[: n + 1] | a[1 : n + 2] << np.uint32(8)
        near = (pair[:n] | a[2 : n + 2] << np.uint32(16)) * np.uint32(2654435761) >> np.uint32(25)
        m = min(n, len(a) - 3)
        far = (pair[:m] | a[3 : m + 3] << np.uint32(16)) * np.uint32(2246822519) >> np.uint32(25)
        counts += np.bincount(near, minlength=BUCKETS)
        if m > 0:
            counts += np.bincount(far, minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    """68 hex digits: the length (eighths of a power of two), two quartile ratios, and a two-bit quartile for each bucket.

    The empty text and texts under three bytes have no triplets: all quartiles are zero.
    """
    data = text.encode()
    counts = triplet_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    packed = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    length = min(255, round(8 * np.log2(len(data) + 1)))
    low, mid = (int(15 * q // q3) if q3 else 0 for q in (q1, q2))
    return bytes([length, low << 4 | mid]).hex() + packed.astype(np.uint8).tobytes().hex()


def difference(a: str, b: str) -> int:
    """Steps between two digests: bucket quartiles (opposite ends count six), length and quartile ratios."""
    x, y = np.frombuffer(bytes.fromhex(a), dtype=np.uint8), np.frombuffer(bytes.fromhex(b), dtype=np.uint8)
    head = abs(int(x[0]) - int(y[0])) + abs(int(x[1] >> 4) - int(y[1] >> 4)) + abs(int(x[1] & 15) - int(y[1] & 15))
    return head + int(_BYTE_STEP[x[2:], y[2:]].sum())


def likeness(a: str, b: str) -> float:
    """1 for equal digests, down to 0 at a difference of ``BOUND``."""
    return 1.0 - min(difference(a, b), BOUND) / BOUND


def edited(text: str, following: str) -> str:
    """The text whose last third is replaced by as many characters from the start of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _row(doc_id, h, text: str, own: str, following: str, other: str) -> tuple:
    changed = edited(text, following)
    mark = own if changed == text else digest(changed)
    return (0, doc_id, h, None, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, mark, likeness(own, mark), likeness(own, other))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in DIGEST_SCHEMA.split(", ")]
    kinds = dict(int=pa.int32(), long=pa.int64(), string=pa.string(), double=pa.float64())
    types = [kinds[f.split()[1]] for f in DIGEST_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted range: each document with the one after it; the first and the last also with their texts."""
    last = None
    for batch in batches:
        rows = []
        for doc_id, h, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "h", "text")), strict=True):
            mark = digest(text)
            if last is None:
                rows.append((1, doc_id, h, text, *[None] * 6))
            else:
                rows.append(_row(*last, text, mark))
            last = (doc_id, h, text, mark)
        if rows:
            yield _batch(rows)
    if last is not None:
        yield _batch([(2, *last[:3], *[None] * 6)])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = zip(*(batch.column(n).to_pylist() for n in ("doc_id", "h", "text", "following")), strict=True)
            yield _batch([_row(d, h, t, digest(t), f, digest(f)) for d, h, t, f in rows])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited form, and the likeness to that and to the next text (descending doc_id).

    One range shuffle brings neighbours together. Only the first and last text of each range are written again, to meet
    the neighbouring range. Null texts count as empty. A null doc_id comes last, equal ids follow the hash of their text
    (equal rows in any order), after the last document comes the first: a single document follows itself. An empty
    table gives no rows; further columns are ignored.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    order: list[Column] = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    ranged = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("h")).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = staged(ranged.mapInArrow(_neighbours, DIGEST_SCHEMA), "digests")
    ends = parts.where("kind > 0").select("kind", "doc_id", "h", "text")
    line = W.orderBy(*order, "kind")  # two rows for each range of documents, ids only
    whole = line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    key = F.struct("doc_id", "h")
    tails = ends.select("kind", "doc_id", "h").withColumn("to", F.coalesce(F.lead(key).over(line), F.first(key).over(whole))).where("kind = 2")
    heads = ends.where("kind = 1").select(F.col("doc_id").alias("d1"), F.col("h").alias("h1"), F.col("text").alias("following"))
    mine = ends.where("kind = 2").select(F.col("doc_id").alias("d2"), F.col("h").alias("h2"), "text")
    met = (
        tails.join(heads, tails["to.doc_id"].eqNullSafe(F.col("d1")) & (tails["to.h"] == F.col("h1")))
        .join(mine, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2"))).select("doc_id", "h", "text", "following")
    )
    return parts.where("kind = 0").unionByName(met.mapInArrow(_edges, DIGEST_SCHEMA)).drop("kind", "h", "text")
