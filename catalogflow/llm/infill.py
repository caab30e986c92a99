"""Fill-in-middle: documents cut in prefix, middle and suffix, put together in another order, and restored.

A document of n units (code points) gives pieces of at most ``PIECE`` units, keyed by document and place in the output.
``repartitionAndSortWithinPartitions`` brings the pieces of a document together in that order, so that a task reads them as a stream
and holds one piece at a time: its digest grows piece by piece. Restoration sees the output alone. It reads the marks, gives each piece the
place it had in the text, and sorts again; since the partitioning is the same, that sort stays within the partition and moves nothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # fixed values: the marks
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
IN_TEXT = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PIECE = 1 << 15  # units of a piece
PART_CHARS = 24_000_000  # characters a task sorts, on average

Key = tuple[int, int, int, int, int]  # hash of the others but the place, id or 0, hash of the text, which of equal rows, place
OUTPUT_SCHEMA = "doc_id long, n long, form string, output string"
DIGEST_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Rule:
    """Which documents change and how: shares in percent, and a seed before the id whose digest draws the numbers."""

    plain: int = 10
    spm: int = 20
    seed: int = 1

    def draws(self, doc_id: int | None) -> list[int]:
        """Four numbers from the id; a null id counts as the empty text."""
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]

    def form(self, doc_id: int | None, text: str) -> str:
        """plain, psm or spm. An empty text, or one that holds a mark, stays plain."""
        _, _, third, fourth = self.draws(doc_id)
        if not text or any(mark in text for mark in IN_TEXT) or third % 100 >= 100 - self.plain:
            return "plain"
        return "spm" if fourth % 100 < self.spm else "psm"

    def cuts(self, doc_id: int | None, n: int) -> tuple[int, int]:
        """Where the prefix and the middle end."""
        first, second, _, _ = self.draws(doc_id)
        return min(first % (n + 1), second % (n + 1)), max(first % (n + 1), second % (n + 1))


def chunks(text: str, start: int, end: int, size: int) -> Iterator[str]:
    """A stretch of the text in pieces."""
    for at in range(start, end, size):
        yield text[at : min(at + size, end)]


def emitted(rows: Iterable, rule: Rule, split: int, size: int) -> Iterator[tuple[Key, tuple]]:
    """The pieces of each document by place in its output; place 0 holds its id and form.

    Equal rows are told apart by task and count, so that they spread over partitions, and a repeated task emits the same
    keys even if it reads its rows in another order.
    """
    seen: Counter[tuple] = Counter()
    for doc_id, text in rows:
        text = text or ""
        own = zlib.crc32(text.encode())
        seen[doc_id, own] += 1
        which = split << 40 | seen[doc_id, own]
        key = (zlib.crc32(f"{doc_id}:{own}:{which}".encode()), doc_id or 0, own, which)
        form = rule.form(doc_id, text)
        yield (*key, 0), (doc_id, form)
        if form == "plain":
            parts: Iterable[str] = chunks(text, 0, len(text), size)
        else:
            low, high = rule.cuts(doc_id, len(text))
            place = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, len(text))}
            parts = (p for mark in ORDERS[form] for p in (mark, *chunks(text, *place[mark], size)))
        for i, part in enumerate(parts, 1):
            yield (*key, i), (part,)


def by_document(key: Key) -> int:
    """The hash that all pieces of a document share."""
    return key[0]


def documents(pieces: Iterable[tuple[Key, tuple]]) -> Iterator[tuple[tuple, tuple, Iterator[str]]]:
    """(key, first value, pieces) of each document of a sorted stream, whose pieces must be read before the next."""
    stream = iter(pieces)
    held = next(stream, None)
    while held is not None:
        key, head = held[0][:-1], held[1]
        held = None

        def rest() -> Iterator[str]:
            nonlocal held
            for k, value in stream:
                if k[:-1] != key:
                    held = (k, value)
                    return
                yield value[0]

        parts = rest()
        yield key, head, parts
        for _ in parts:  # whatever was not read
            pass


def assembled(docs: DataFrame, rule: Rule = Rule(), size: int = PIECE) -> RDD:
    """Pieces of all documents in the order of their outputs, each document within one partition."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / PART_CHARS), min(docs.sparkSession.sparkContext.defaultParallelism, total // (1 << 20)))
    emit = rows.rdd.mapPartitionsWithIndex(lambda split, part: emitted(part, rule, split, size))
    return emit.repartitionAndSortWithinPartitions(parts, by_document)


def restoring(pieces: Iterable[tuple[Key, tuple]]) -> Iterator[tuple[Key, tuple]]:
    """The pieces of outputs by place in the text, and at place -1 what the output showed: its digest, form and lengths."""
    for key, (doc_id, form), parts in documents(pieces):
        digest = hashlib.sha256()
        length = {mark: 0 for mark in IN_TEXT}
        mark, number = PREFIX, 0
        for part in parts:
            digest.update(part.encode())
            if form != "plain" and part in IN_TEXT:  # no text that is cut holds a mark
                mark = part
                continue
            length[mark] += len(part)
            number += 1
            yield (*key, IN_TEXT[mark] << 40 | number), (part,)
        sizes = (None, None) if form == "plain" else (length[PREFIX], length[MIDDLE])
        yield (*key, -1), (doc_id, sum(length.values()), form, *sizes, digest.hexdigest())


def restored(pieces: RDD) -> RDD:
    """Pieces of all documents in the order of their texts, from the pieces of their outputs. Nothing is moved between partitions."""
    moved = pieces.mapPartitions(restoring, preservesPartitioning=True)
    return moved.repartitionAndSortWithinPartitions(pieces.getNumPartitions(), by_document)


def transform(docs: DataFrame, rule: Rule = Rule(), size: int = PIECE) -> DataFrame:
    """(doc_id, n, form, output): the output text of every whole document.

    Null and empty texts stay plain and empty. Rows with equal or null ids, and equal rows, are documents of their own; further
    columns are ignored; an empty table gives no rows.
    """

    def joined(pieces: Iterable) -> Iterator[tuple]:
        for _, (doc_id, form), parts in documents(pieces):
            output = "".join(parts)
            yield doc_id, len(output) - (0 if form == "plain" else sum(map(len, IN_TEXT))), form, output

    return docs.sparkSession.createDataFrame(assembled(docs, rule, size).mapPartitions(joined), OUTPUT_SCHEMA, verifySchema=False)


def digests(docs: DataFrame, rule: Rule = Rule(), size: int = PIECE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every whole document, treated as by ``transform``.

    Lengths and the restored text's digest come from the output; no task holds more of a document than a piece while it reads outputs.
    """

    def finished(pieces: Iterable) -> Iterator[tuple]:
        for _, shown, parts in documents(pieces):
            digest = hashlib.sha256()
            for part in parts:
                digest.update(part.encode())
            yield *shown, digest.hexdigest()

    rows = restored(assembled(docs, rule, size)).mapPartitions(finished)
    return docs.sparkSession.createDataFrame(rows, DIGEST_SCHEMA, verifySchema=False)
