"""Near duplicates by ProbMinHash over word shingles, banding, exact verification, and connected classes.

1. Texts with the same multiset of shingles are one text; the one of the smallest id stands for them.
2. ProbMinHash: each shingle's points arrive as a Poisson process of its weight, each at a random one of ``K`` places; a place
   keeps the shingle of its earliest point. A process ends once its next point is later than every place's earliest. Two
   signatures agree at a place with the probability Jaccard similarity of the weights. Every text has a signature with weight 1
   for each distinct shingle, for which that is the Jaccard similarity that step 4 verifies; a text that repeats shingles has a second
   one weighted by their counts, which brings it to texts that repeat them alike (without repeats the two are the same).
3. Texts whose signatures agree in all ``R`` places of a band meet in a bucket. A pair of similarity 0.8 meets in one of the
   B = K / R bands with probability 1 - (1 - 0.8 ** R) ** B > 0.99999, however often either text repeats its shingles.
4. Each text of a bucket is compared with the bucket's smallest id, exactly (distinct shingles, Jaccard).
5. Texts that then share a bucket but not a class are joined on rare shingles: sets of n shingles with a similarity of 0.8 share one of their
   n - ceil(0.8 n) + 1 rarest. Only pairs that share such a one are compared, so a bucket is never compared all with all, and no link is lost.
6. Classes are the connected components of the links, found by passing the smallest id along, with the links shortened.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalogflow.llm.common import by_batch, staged, texts, words

WIDTH = 5  # words of a shingle
R, B = 5, 30
K = R * B
SIMILAR = 0.8
CACHE = 400_000
PARITY = 8  # words of 64 bits
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash, computed when first met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        data = word.encode()
        self[word] = h = zlib.crc32(data) << 32 | zlib.crc32(data, 0x9E3779B9)
        return h


def shingles(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of a text, ascending, and their counts. A text of fewer words is one shingle, one without words has none."""
    w = np.array(list(map(hashes.__getitem__, words(text))), dtype=np.uint64)
    if not len(w):
        return w, np.zeros(0, dtype=np.int64)
    n = max(len(w) - WIDTH + 1, 1)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(WIDTH, len(w))):
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(h, return_counts=True)


def signatures(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """ProbMinHash signatures [text, place] of weighted shingle sets, all texts of a batch together.

    The i-th point of a shingle arrives after an exponential wait of rate weight; waits and places depend on shingle and i alone.
    """
    size = np.array([len(h) for h, _ in parts], dtype=np.int64)
    doc = np.repeat(np.arange(len(parts)), size)
    h = np.concatenate([x for x, _ in parts]) if len(parts) else np.zeros(0, dtype=np.uint64)
    weight = np.concatenate([c for _, c in parts]).astype(np.float64) if len(parts) else np.zeros(0)
    earliest, owner = np.full((len(parts), K), np.inf), np.zeros((len(parts), K), dtype=np.uint64)
    when, i = np.zeros(len(h)), 0
    while len(h):
        with np.errstate(over="ignore"):
            x = _mixed(h + np.uint64(i + 1) * np.uint64(0xD6E8FEB86659FD93))
        when = when - np.log((np.float64(1) + (x >> np.uint64(11)).astype(np.float64)) / 2.0**53) / weight
        place = ((x & np.uint64(2047)) * np.uint64(K) >> np.uint64(11)).astype(np.int64)
        cell = doc * K + place
        hit = when < earliest.reshape(-1)[cell]
        if hit.any():
            c, t, own = cell[hit], when[hit], h[hit]
            order = np.lexsort((own, -t, c))  # the earliest of a cell comes last and stays
            c, t, own = c[order], t[order], own[order]
            earliest.reshape(-1)[c] = t
            owner.reshape(-1)[c] = own
        alive = when < earliest.max(1)[doc]  # a later point of the others can no longer be the first anywhere
        h, weight, when, doc = h[alive], weight[alive], when[alive], doc[alive]
        i += 1
    return owner


def _bands(signature: np.ndarray) -> np.ndarray:
    """One hash for each band of each signature."""
    out = np.zeros((len(signature), B), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(R):
            out = _mixed(out * np.uint64(31) + signature[:, r::R])
        return _mixed(out + np.arange(B, dtype=np.uint64)).view(np.int64)


def content_hash(h: np.ndarray, c: np.ndarray) -> int:
    """A hash of weighted shingles."""
    return zlib.crc32(h.tobytes() + c.tobytes()) << 31 ^ int(_mixed(h * c.astype(np.uint64)).sum(dtype=np.uint64) >> np.uint64(1))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, content, n, bands): hash of the weighted shingles, number of distinct ones, and band hashes.

    The first ``B`` hashes are those of the set. A text with repeated shingles has ``B`` more, of the weighted ones, null where they agree.
    """
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [shingles(t, hashes) for t in texts(batch)]
        plain = _bands(signatures([(h, np.ones(len(h), dtype=np.int64)) for h, _ in parts]))
        bands = [b.tolist() if len(h) else [] for b, (h, _) in zip(plain, parts, strict=True)]
        several = [i for i, (_, c) in enumerate(parts) if len(c) and c.max() > 1]
        for i, weighted in zip(several, _bands(signatures([parts[i] for i in several])), strict=True):
            bands[i] += [None if x == y else y for x, y in zip(bands[i], weighted.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), pa.array([content_hash(h, c) for h, c in parts], pa.int64()),
            pa.array([len(h) for h, _ in parts], pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "content", "n", "bands"])

    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, content long, n long, bands array<long>")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, similarity) of pairs of text numbers, from their shingle sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")).cast("double"))
    return both.select("a", "b", (F.col("shared") / (F.size("sa") + F.size("sb") - F.col("shared"))).alias("similarity"))


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, s) of the wanted texts (doc_id, content): hashes of the distinct shingles. Of several texts of one id only that one counts."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [shingles(t, hashes) for t in texts(batch)]
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), pa.array([content_hash(h, c) for h, c in parts], pa.int64()),
            pa.array([h.view(np.int64) for h, _ in parts], pa.list_(pa.int64()))], names=["doc_id", "content", "s"])

    some = docs.select("doc_id", "text").join(wanted.select("doc_id"), "doc_id", "left_semi")
    found = by_batch(some, run, "doc_id long, content long, s array<long>")
    return found.join(wanted, ["doc_id", "content"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "s")


def rare_pairs(sets: DataFrame, similar: float) -> DataFrame:
    """(a, b) of the sets (doc_id, n, c, s) of different c that may be so similar.

    Two such sets share one of the n - ceil(similar * n) + 1 rarest members of the larger and one of the n - ceil(2 similar / (1 + similar) * n) + 1
    rarest of the smaller one. What a set shares with no other counts against it: the rest must still hold the overlap that the sizes ask for.
    And a set's members toggle one of ``64 * PARITY`` bits each: as many bits as differ between two sets, so many members at least differ.
    """
    member = sets.select("doc_id", F.explode("s").alias("h"))
    often = member.groupBy("h").agg(F.count(F.lit(1)).alias("often"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(63).cast("int"))
    word = F.shiftrightunsigned("h", 6).bitwiseAND(PARITY - 1)
    toggled = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"p{k}") for k in range(PARITY)]
    ranked = member.join(often, "h").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("often", "h"))).alias("r"), *toggled)
    n = F.col("n").cast("double")
    left = lambda share: (F.col("n") - F.ceil(n * share - 1e-9) + 1).cast("int")
    rows = ranked.join(sets.select("doc_id", "n", "c"), "doc_id").withColumn("most", F.size(F.filter("r", lambda x: x["often"] > 1)))
    rows = rows.where(F.col("most") >= n * similar - 1e-9)
    rare = lambda share: F.explode(F.filter(F.slice("r", F.lit(1), left(share)), lambda x: x["often"] > 1)["h"]).alias("h")
    parity = [f"p{k}" for k in range(PARITY)]
    small = rows.select(F.col("doc_id").alias("x"), "n", "c", "most", *parity, rare(2 * similar / (1 + similar)))
    large = rows.select(F.col("doc_id").alias("y"), F.col("n").alias("ny"), F.col("c").alias("cy"), F.col("most").alias("my"), *[F.col(p).alias(f"y{p}") for p in parity], rare(similar))
    smaller = (F.col("n") < F.col("ny")) | (F.col("n") == F.col("ny")) & (F.col("x") < F.col("y"))
    enough = F.least("most", "my") * (1 + similar) >= similar * (F.col("n") + F.col("ny")) - 1e-9
    unlike = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"y{p}"))) for p in parity), F.lit(0))
    enough &= unlike <= (F.col("n") + F.col("ny")) * ((1 - similar) / (1 + similar)) + 1e-9
    met = small.join(large, "h").where(smaller & (F.col("c") != F.col("cy")) & (F.col("n") >= similar * F.col("ny") - 1e-9) & enough)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def classes(links: DataFrame, name: str = "classes") -> DataFrame:
    """(doc_id, class) for every end of the links (a, b): the smallest number that is connected to it.

    Each round, both ends of a link move to the smallest number around its larger end, and the larger end also to the smallest
    one around its smaller end, until all point at the smallest of their component. Written each round.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v > u").distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        ends = edges.join(least, "v").join(least.select(F.col("v").alias("u"), F.col("m").alias("mu")), "u")
        same = ((F.col("m") == F.col("u")) & (F.col("mu") == F.col("u"))).alias("same")
        pairs = F.array(F.struct("v", F.col("m").alias("u"), same), F.struct(F.col("u").alias("v"), F.col("m").alias("u"), same), F.struct("v", F.col("mu").alias("u"), same))
        moved = ends.select(F.explode(pairs).alias("e")).select("e.*").where("v > u").groupBy("v", "u").agg(F.min("same").alias("same"))
        after = staged(moved, name)
        edges = after.select("v", "u")
        if not after.where("NOT same").limit(1).count():  # nothing moved: each number has one link, to the smallest of its component
            return edges.select(F.col("v").alias("doc_id"), F.col("u").alias("class")).unionByName(edges.select(F.col("u").alias("doc_id"), F.col("u").alias("class")).distinct())


def groups(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id, links): the smallest id of each document's class, and how many different texts it is linked to.

    Links are the verified pairs: those to the first of each shared bucket, and those that join what was not yet in one class.
    Texts with the same shingles share all of this. Texts without words are alike and form a class of their own. doc_id must
    be unique for that; rows of one id count as one document of the smallest content, rows without an id are left out (a
    class is named by an id). Further columns are ignored; an empty table gives no rows.
    """
    sketch = staged(sketches(docs.where("doc_id IS NOT NULL")), "sketches")
    one = sketch.groupBy("doc_id").agg(F.min(F.struct("content", "n", "bands")).alias("x")).select("doc_id", "x.*") if _repeats(sketch) else sketch
    first = one.groupBy("content").agg(F.min("doc_id").alias("rep"))
    reps = staged(one.join(first.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "texts")
    met = reps.where("n > 0").select("doc_id", "n", F.posexplode("bands").alias("band", "key")).where("key IS NOT NULL").withColumn("band", F.col("band") % B)
    bucket = met.groupBy("band", "key").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(met.join(bucket, ["band", "key"]).where("lead < doc_id").select("band", "key", "lead", "doc_id"), "members")
    pairs = members.select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = staged(shingle_sets(docs, reps.select("doc_id", "content").join(ends, "doc_id", "left_semi")), "shingles")
    stars = staged(compared(pairs, sets), "stars")
    links = stars.where(F.col("similarity") >= similar)
    known = classes(links)

    # texts of buckets whose members are not all in the class of the smallest id
    rest = members.select("band", "key", "lead", "doc_id").join(known.withColumnRenamed("class", "c"), "doc_id", "left").withColumn("c", F.coalesce("c", "doc_id"))
    lead = known.select(F.col("doc_id").alias("lead"), F.col("class").alias("lc"))
    rest = rest.join(lead, "lead", "left").withColumn("lc", F.coalesce("lc", "lead"))
    several = rest.groupBy("band", "key").agg(F.max(F.col("c") != F.col("lc")).alias("open")).where("open").select("band", "key")
    texts_open = rest.join(several, ["band", "key"]).select("doc_id", "c").distinct()
    open_sets = staged(sets.join(texts_open, "doc_id").select("doc_id", F.size("s").alias("n"), "c", "s"), "open")
    more = compared(rare_pairs(open_sets, similar), open_sets.select("doc_id", "s"))
    more_links = staged(more.where(F.col("similarity") >= similar).select("a", "b"), "links")
    every = links.select("a", "b").unionByName(more_links)
    final = known if not more_links.limit(1).count() else classes(known.select(F.col("doc_id").alias("b"), F.col("class").alias("a")).unionByName(more_links.select("b", "a")))

    degree = every.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    named = first.join(final.select(F.col("doc_id").alias("rep"), "class"), "rep", "left").join(degree, "rep", "left").select(
        "content", F.coalesce("class", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return one.select("doc_id", "content").join(named, "content").select("doc_id", "class_id", "links")


def _repeats(sketch: DataFrame) -> bool:
    """Whether some id occurs twice."""
    return bool(sketch.groupBy("doc_id").count().where("count > 1").limit(1).count())


def kept(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one document of each class: that of the smallest id. Of repeated rows of that id one stays; rows without an id stay."""
    first = groups(docs, similar).where("doc_id = class_id").select("doc_id")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")  # columns may have any names
    one = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi").select(whole)
    if _repeats(docs.where("doc_id IS NOT NULL")):  # asked of the ids alone: the classes are evaluated once
        order = W.partitionBy("r.doc_id").orderBy(F.xxhash64("r"))
        one = one.withColumn("k", F.row_number().over(order)).where("k = 1")
    return one.unionByName(docs.where("doc_id IS NULL").select(whole), allowMissingColumns=True).select("r.*").select(*[f"`{c}`" for c in docs.columns])
