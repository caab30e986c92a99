"""Approximate nearest neighbours: inverted lists, and within them an adaptive scan of rotated dimensions.

Vectors get one more coordinate that makes all norms equal, so that the largest inner product is the smallest distance, and are
rotated at random. Within each probed list, distances grow by blocks of dimensions; after each block a hypothesis test
drops the candidates whose distance, estimated from the dimensions seen, exceeds the query's bound by more than chance. The
bound of a query is its last result from the lists nearest to it, which are scanned first. Survivors get the exact product.
A query whose lists hold too few vectors is answered from all lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalogflow.llm.common import by_batch, staged

STEP = 16  # dimensions in a block
EPSILON = 2.1  # how many deviations over the bound an estimate may be
FIRST = 2  # lists scanned to find each query's bound
LIST_ROWS, QUERY_ROWS = 4096, 1024  # most of a list, and of its queries, that meet in one task at a time
FOUND_SCHEMA = "rep long, vec_id long, score double"


@dataclass
class Lists:
    """Centroids of the vectors with even norms, the rotation, the common norm, and how many lists a query probes."""

    centroids: np.ndarray
    rotation: np.ndarray
    norm: float
    probes: int


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of number lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: of the most frequent length, finite and not zero.

    Entries of single precision stay so, all others are of double precision.
    """
    e = F.col("embedding")
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    wrong = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select(F.col("vec_id").cast("long"), e.cast(kind).alias("embedding")).where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL").where(~wrong & F.exists(e, lambda x: x != 0))
    size = good.groupBy(F.size("embedding").alias("s")).count().orderBy(F.desc("count"), "s").first()
    return good.where(F.size("embedding") == (size["s"] if size else 0))


def even(x: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Vectors with the coordinate that evens norms, zero for queries."""
    more = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm**2 - (x.astype(np.float64) ** 2).sum(1), 0))
    return np.hstack([x, more[:, None]]).astype(np.float32)


def near_lists(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Score of every list for every vector with even norm or query, smaller is nearer."""
    return (centroids * centroids).sum(1) - 2 * x @ centroids.T


def fit(good: DataFrame, recall: float = 0.96, rows: int = 20_000, most: int = 4096, k: int = 20, seed: int = 2) -> Lists | None:
    """Lists from at most ``rows`` vectors of the smallest hashed ids, and the fewest probes that find ``recall`` of the sample's own neighbours."""
    stats = good.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))).first()
    n, norm = stats[0], stats[1]
    if not n:
        return None
    x = matrix(good.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(rows).select("embedding").toArrow()["embedding"]).astype(np.float32)
    q_all, x = even(x, norm, True), even(x, norm, False)
    rng = np.random.default_rng(seed)
    lists = int(min(most, max(1, round(n**0.5)), len(x)))
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(8):
        own = np.concatenate([near_lists(x[i : i + 2048], c).argmin(1) for i in range(0, len(x), 2048)])
        count = np.bincount(own, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    own = np.concatenate([near_lists(x[i : i + 2048], c).argmin(1) for i in range(0, len(x), 2048)])
    q = rng.choice(len(x), min(200, len(x)), replace=False)
    s = q_all[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    top = np.argsort(-s, axis=1)[:, : min(k, max(len(x) - 1, 1))]
    rank = np.argsort(np.argsort(near_lists(q_all[q], c), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, own[top], 1).reshape(-1))
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
    d = x.shape[1]
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.float32)
    return Lists(c.astype(np.float32), rotation, float(norm), min(lists, probes))


def rotated(x: np.ndarray, model: Lists, query: bool) -> np.ndarray:
    """Vectors with even norms, rotated."""
    return even(x, model.norm, query) @ model.rotation


def adaptive_scan(q: np.ndarray, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) numbers of the pairs that no test has dropped. ``limit``: squared distances, infinite without a bound."""
    dims = x.shape[1]

    def test(part: np.ndarray, seen: int, lim: np.ndarray) -> np.ndarray:
        return part * (dims / seen) <= lim * (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else part <= lim * (1 + 1e-4) + 1e-6

    s = slice(0, min(STEP, dims))
    part = np.maximum((q[:, s] ** 2).sum(1)[:, None] + (x[:, s] ** 2).sum(1)[None] - 2 * q[:, s] @ x[:, s].T, 0)
    i, j = np.nonzero(test(part, s.stop, limit[:, None]))
    part = part[i, j]
    for at in range(STEP, dims, STEP):
        s = slice(at, min(at + STEP, dims))
        for k in range(0, len(i), 100_000):
            d = q[i[k : k + 100_000], s] - x[j[k : k + 100_000], s]
            part[k : k + 100_000] += (d * d).sum(1)
        stay = test(part, s.stop, limit[i])
        i, j, part = i[stay], j[stay], part[stay]
    return i, j


def scan_list(ids: np.ndarray, x: np.ndarray, reps: np.ndarray, q: np.ndarray, bound: np.ndarray, model: Lists, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, vec_id, score) of up to k results of each query in a part of a list, none under its bound."""
    xr, qr = rotated(x, model, False), rotated(q, model, True)
    limit = (q.astype(np.float64) ** 2).sum(1) + model.norm**2 - 2 * bound
    free = np.flatnonzero(~np.isfinite(bound))
    if len(free):  # no bound yet: that of the first candidates
        some = x[: max(4 * k, 128)].astype(np.float64)
        if len(some) > k:
            own = np.partition(-(q[free].astype(np.float64) @ some.T), k - 1, axis=1)[:, k - 1]
            limit[free] = (q[free].astype(np.float64) ** 2).sum(1) + model.norm**2 + 2 * own
    i, j = adaptive_scan(qr, xr, limit.astype(np.float32))
    score = np.empty(len(i))
    for at in range(0, len(i), 100_000):
        score[at : at + 100_000] = (q[i[at : at + 100_000]].astype(np.float64) * x[j[at : at + 100_000]]).sum(1)
    stay = score >= bound[i]
    i, j, score = i[stay], j[stay], score[stay]
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return reps[i[place < k]], ids[j[place < k]], score[place < k]


def search(vectors: DataFrame, divisor: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors of each vector whose id ``divisor`` divides.

    Equal vectors are candidates with their k + 1 smallest ids only, which is all that k results can need, and equal queries are
    searched once. Repeated ids are vectors of their own (a query never finds its own id). Vectors that are null, zero, not
    finite, of another length than most, or without an id take no part; a table without any gives no rows.
    """
    spark = vectors.sparkSession
    good = usable(vectors)
    kind = dict(good.dtypes)["embedding"]
    model = fit(good)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(model)  # at most 4096 centroids
    dims = W.partitionBy("embedding").orderBy("vec_id")
    candidates = good.withColumn("_r", F.row_number().over(dims)).where(F.col("_r") <= k + 1).drop("_r")

    def lists_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = near_lists(even(matrix(batch.column("embedding")), shared.value.norm, False), shared.value.centroids).argmin(1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=[*batch.schema.names, "list"])

    def probes_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        order = np.argsort(near_lists(even(matrix(batch.column("embedding")), shared.value.norm, True), shared.value.centroids), axis=1, kind="stable")[:, : shared.value.probes]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(order.astype(np.int32)))], names=[*batch.schema.names, "probes"])

    rows = staged(by_batch(candidates, lists_of, f"vec_id long, embedding {kind}, list int"), "lists")
    size = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).cast("int").alias("parts"))
    rows = rows.join(size, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int")).drop("parts")
    asked = good.where(F.col("vec_id") % divisor == 0)
    distinct = asked.groupBy("embedding").agg(F.min("vec_id").alias("rep"))
    queries = staged(by_batch(distinct.select("rep", "embedding"), probes_of, f"rep long, embedding {kind}, probes array<int>"), "queries")

    def scan(bounded: DataFrame, probes) -> DataFrame:
        asked_of = bounded.select("rep", "embedding", "bound", F.explode(probes).alias("list"))
        turns = asked_of.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("turns"))
        parted = asked_of.join(turns, "list").withColumn("turn", F.pmod(F.xxhash64("rep"), "turns").cast("int")).drop("turns")
        left = parted.join(size, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        right = rows.join(turns, "list").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")

        def cell(a: pa.Table, b: pa.Table) -> pa.Table:
            types = [pa.int64(), pa.int64(), pa.float64()]
            if a.num_rows and b.num_rows:
                found = scan_list(b["vec_id"].to_numpy(), matrix(b["embedding"]), a["rep"].to_numpy(), matrix(a["embedding"]), a["bound"].to_numpy(), shared.value, k + 1)
            else:
                found = ([], [], [])
            return pa.table([pa.array(c, t) for c, t in zip(found, types, strict=True)], names=["rep", "vec_id", "score"])

        keys = ("list", "part", "turn")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, FOUND_SCHEMA)

    best = W.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    none = F.lit(float("-inf"))
    first = staged(scan(queries.withColumn("bound", none), F.slice("probes", 1, FIRST)), "first")
    last = first.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == k + 1).select("rep", F.col("score").alias("bound"))
    rest = queries.where(F.size("probes") > FIRST).join(last, "rep", "left").withColumn("bound", F.coalesce("bound", none))
    second = scan(rest, F.slice("probes", FIRST + 1, model.probes))
    top = staged(first.unionByName(second).withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r"), "top")
    wanted = min(k + 1, rows.count())
    held = top.groupBy("rep").agg(F.count(F.lit(1)).alias("held"))
    short = queries.join(held, "rep", "left").where(F.coalesce("held", F.lit(0)) < wanted).withColumn("bound", none)
    if not short.isEmpty():  # their lists hold too few: all others as well, without a bound
        every = F.sequence(F.lit(0), F.lit(len(model.centroids) - 1))
        third = scan(short, F.array_except(every, "probes"))
        top = top.unionByName(third).withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    named = asked.select(F.col("vec_id").alias("query_id"), "embedding").join(distinct, "embedding").select("query_id", "rep")
    mine = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return named.join(top, "rep").where("vec_id <> query_id").withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
