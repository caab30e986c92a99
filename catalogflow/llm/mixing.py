"""Mixing sources to target weights by a proportionally fair (Pfair) schedule, in DataFrame operations only.

Documents of a source form blocks of ``block_rows``. In each cycle a source of weight w owns about w * cycle block slots.
Its j-th block of the cycle (of b in m slots) is released at floor((j - 1) m / b) and due at ceil(j m / b); the slot goes
to the released block that is due first. At every slot each source is then less than one block from its exact share of
the cycle, and at the end of a cycle the deviation is zero. A source that runs out leaves its slots to the others, so
every document is kept. Cycles with equal block counts share one schedule, of which there are at most 2 * sources + 1;
sources with equally many blocks in it are scheduled as one class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalogflow.functions.binding import bound
from catalogflow.llm.common import staged

PIECE = 256  # slots gathered before they are put to the others


def _schedule(classes: Column, m: Column) -> Column:
    """Earliest due block first among released ones: an array of (class number, block number in the class) for slots 0 to m - 1.

    A class is a struct of ``b`` and ``k``: k sources with b blocks each, whose j-th blocks share a window. Its r-th block is block r div k of
    its source r mod k. Picks are gathered in pieces, so that the time grows with slots times classes.
    """
    empty = F.array().cast("array<struct<i:int,r:bigint>>")

    def step(acc: Column, t: Column) -> Column:
        def due(c: Column, i: Column) -> Column:
            done = acc["done"][i]
            j = F.floor(done / c["k"])
            return F.when((done < c["b"] * c["k"]) & (F.floor(j * m / c["b"]) <= t), F.struct(F.ceil((j + 1) * m / c["b"]).alias("due"), i.alias("i")))

        return bound(F.array_min(F.transform(classes, due))["i"], lambda i: F.struct(
            F.transform(acc["done"], lambda x, k: F.when(k == i, x + 1).otherwise(x)).alias("done"),
            F.concat(acc["picks"], F.array(F.struct(i.alias("i"), acc["done"][i].alias("r")))).alias("picks")))

    def piece(acc: Column, start: Column) -> Column:
        first = F.struct(acc["done"].alias("done"), empty.alias("picks"))
        slots = F.sequence(start, F.least(start + PIECE, m) - 1)
        return bound(F.aggregate(slots, first, step), lambda got: F.struct(
            got["done"].alias("done"), F.concat(acc["pieces"], F.array(got["picks"])).alias("pieces")))

    begin = F.struct(F.transform(classes, lambda c: F.lit(0).cast("long")).alias("done"), F.array().cast("array<array<struct<i:int,r:bigint>>>").alias("pieces"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), m - 1, F.lit(PIECE).cast("long")), begin, piece, lambda acc: F.flatten(acc["pieces"]))


def plan(counts: DataFrame, block_rows: int, cycle: int) -> DataFrame:
    """Rows (source, share, parts) from (source, n, weight): blocks a cycle, and schedules by first cycle.

    A part has the first cycle it holds for, the first slot of that cycle, the cycle's slots and the slot of each block. Parts begin where a
    source runs out. In a part, sources with equally many blocks form a class; there are at most about sqrt(2 m) classes for m
    slots. The parts are scheduled in parallel, and their slots together are at most the blocks of all sources. One task
    orders a number or two for each source. What the parts hold and the slots of their blocks are written in between: the driver keeps a
    plan and its text for each stage that ends, so one plan of all the steps takes its memory many times over.
    """
    alone = W.partitionBy(F.lit(0))
    whole = alone.orderBy("source").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # in order: the sum is the same each time
    share = F.greatest(F.lit(1), F.coalesce(F.round(F.try_divide(F.col("weight") * cycle, F.sum("weight").over(whole))), F.lit(1))).cast("long")
    sources = counts.select("source", F.ceil(F.col("n") / block_rows).alias("n"), share.alias("a")).withColumn("end", F.ceil(F.col("n") / F.col("a")))
    starts = sources.select(F.explode(F.array(F.lit(0).cast("long"), F.floor(F.col("n") / F.col("a")), "end")).alias("first")).distinct()
    starts = starts.select("first", (F.row_number().over(alone.orderBy("first")) - 1).alias("p"), F.lead("first").over(alone.orderBy("first")).alias("next"))
    ends = starts.select(F.col("first").alias("end"), F.col("p").alias("last"))
    live = sources.join(ends, "end").select("source", "a", "n", F.explode(F.sequence(F.lit(0), F.col("last") - 1)).alias("p")).join(starts, "p")
    live = live.withColumn("b", F.least(F.col("a"), F.col("n") - F.col("a") * F.col("first")))
    live = staged(live.withColumn("member", (F.row_number().over(W.partitionBy("p", "b").orderBy("source")) - 1).cast("long")), "mixture-parts")

    classes = live.groupBy("p", "first", "next", "b").agg(F.count(F.lit(1)).alias("k"))
    parts = classes.groupBy("p", "first", "next").agg(
        F.sum(F.col("b") * F.col("k")).alias("m"), F.reverse(F.array_sort(F.collect_list(F.struct("b", "k")))).alias("classes"))
    before = F.sum(F.col("m") * (F.col("next") - F.col("first"))).over(alone.orderBy("p").rowsBetween(W.unboundedPreceding, -1))
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number: run-time coalescing would put all in one task
    picks = parts.withColumn("base", F.coalesce(before, F.lit(0))).repartition(tasks, "p").withColumn("picks", _schedule(F.col("classes"), F.col("m")))
    slots = picks.select("p", "first", "base", "m", "classes", F.posexplode("picks").alias("t", "x")).withColumn("c", F.col("classes")[F.col("x.i")])
    slots = slots.select("p", "first", "base", "m", "t", F.col("c.b").alias("b"), (F.col("x.r") % F.col("c.k")).alias("member"), F.floor(F.col("x.r") / F.col("c.k")).alias("j"))
    owners = live.select("p", "b", "member", "source", "a").hint("merge")  # compressed files look smaller than their rows, too small to go by for a broadcast
    per = slots.join(owners, ["p", "b", "member"]).groupBy("source", "a", "first", "base", "m").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", "t"))), lambda x: x["t"]).alias("slots"))
    per = staged(per, "mixture-slots")
    return per.groupBy("source", F.col("a").alias("share")).agg(F.array_sort(F.collect_list(F.struct("first", "base", "m", "slots"))).alias("parts"))


def sources_of(docs: DataFrame) -> DataFrame:
    """(source, n, g): the rows of each source and a number for it; written, so that Spark's size check sees how small the table is."""
    return staged(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("g", F.monotonically_increasing_id()), "mixture-sources")


def numbered_by_source(
    docs: DataFrame, key: list[str], bucket_rows: int, sources: DataFrame | None = None, extend: Callable[[DataFrame], DataFrame] = lambda buckets: buckets,
) -> DataFrame:
    """(d, s, n, k): each row as a struct with its source, the rows of that source, and its number there from 0 in the order of hashes.

    A source is cut into buckets of about ``bucket_rows`` by a hash of the key and the whole row, numbered apart and put together by their
    counts, so no task sorts a whole source, also where many keys are equal or null. Rows equal in every column share a bucket. ``extend`` may add
    columns to the buckets ``(g, b, c, o)``: source number, bucket, its rows, rows of the source before it. Rows meet them where their bucket was
    sorted, so whole rows are shuffled once.
    """
    sources = sources_of(docs) if sources is None else sources
    whole = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col("source").alias("s"), F.xxhash64(*[F.col(f"`{c}`") for c in key], *whole).alias("h"))
    size = sources.withColumnRenamed("source", "s1")
    hashed = rows.join(size, rows["s"].eqNullSafe(size["s1"])).drop("s1").withColumn("b", F.pmod("h", F.ceil(F.col("n") / bucket_rows)))
    buckets = hashed.groupBy("g", "b").agg(F.count(F.lit(1)).alias("c"))
    buckets = buckets.withColumn("o", F.coalesce(F.sum("c").over(W.partitionBy("g").orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = hashed.withColumn("r", F.row_number().over(W.partitionBy("g", "b").orderBy("h", *[F.col(f"d.`{c}`") for c in key])))
    return inside.join(extend(buckets), ["g", "b"]).withColumn("k", F.col("o") + F.col("r") - 1).drop("g", "b", "c", "h", "r")


def mix(
    docs: DataFrame, weights: DataFrame | None = None, key: list[str] | None = None, block_rows: int = 64,
    cycle: int = 1000, power: float = 0.7, bucket_rows: int = 1024,
) -> DataFrame:
    """``docs`` with ``block`` (number within its source), ``slot`` (of the block in the mixture) and ``place`` in the block.

    ``weights`` has (source, weight); a source without a positive weight there takes its share of one block a cycle.
    Without ``weights`` a source of n documents weighs n ** power. Weights are held to the nearest 1 / ``cycle``, at least one
    block a cycle each. No row is dropped or repeated. A null source is a source of its own; null texts and keys, repeated
    rows and further columns stay as they are, whatever their names; columns that are named block, slot or place give way to the
    operator's. An empty table gives none. Ties of the key are put in any order.
    """
    sources = sources_of(docs)
    counts = sources.select("source", "n")
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = weights.groupBy(F.col("source").alias("_ws")).agg(F.max("weight").cast("double").alias("weight"))
        counts = counts.join(given, counts["source"].eqNullSafe(given["_ws"]), "left").select("source", "n", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"))
    numbers = sources.select(F.col("source").alias("s1"), "g")
    planned = plan(counts, block_rows, cycle)
    schedule = planned.join(numbers, planned["source"].eqNullSafe(numbers["s1"])).select("g", "share", "parts")

    first = F.floor(F.col("o") / block_rows)
    turn = F.floor(F.col("block") / F.col("share"))
    part = F.element_at(F.filter("parts", lambda p: p["first"] <= F.col("turn")), -1)
    slot = F.col("part.base") + (F.col("turn") - F.col("part.first")) * F.col("part.m") + F.col("part.slots")[(F.col("block") - F.col("turn") * F.col("share")).cast("int")]

    def with_slots(buckets: DataFrame) -> DataFrame:
        """Buckets with the slots of the blocks that their rows fall into."""
        blocks = buckets.select("g", "b", "o", F.explode(F.sequence(first, F.floor((F.col("o") + F.col("c") - 1) / block_rows))).alias("block"))
        placed = blocks.join(schedule, "g").withColumn("turn", turn).withColumn("part", part).select("g", "b", "o", "block", slot.alias("slot"))
        return placed.groupBy("g", "b", "o").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "slot"))), lambda x: x["slot"]).alias("slots"))

    out = numbered_by_source(docs, key or ["doc_id"], bucket_rows, sources, with_slots).withColumn("block", F.floor(F.col("k") / block_rows))
    kept = [F.col(f"d.`{c}`").alias(c) for c in docs.columns if c not in ("block", "slot", "place")]
    own = F.col("slots")[(F.col("block") - first).cast("int")]
    return out.select(*kept, "block", own.alias("slot"), (F.col("k") - F.col("block") * block_rows).alias("place"))
