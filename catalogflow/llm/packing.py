"""Hierarchical packing of tokenized documents into sequences of several context sizes.

A document is cut into windows of the longest context while it fills them; its rest goes to the shortest tier that holds
it. Tiers are packed from the longest to the shortest: each rest opens a window of its tier, gaps are filled with the
longest fitting rests of the shorter tiers, and what still lacks is cut from one rest, so that every window is full. What
is left at the end is cut into windows of smaller powers of two, and only the last, shorter than ``least``, needs padding.
The windows of a pool are then dealt to step groups of equal size by descending attention cost.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import small_batches, texts

PLACE_SCHEMA = "pool_file long, pool_row long"
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, context long, step_group long"
CACHE = 400_000  # chunks whose ids a worker remembers; beyond that it starts anew


# A chunk of letters up to U+00FF and then signs: two words of the tokenizer at most, whose bytes it writes as printable letters.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512), strict=False))


class ChunkTokenizer:
    """Ids of texts by a tokenizer, remembered for each run of characters between blanks and line ends.

    The tokenizers handled here cut texts at white space before they encode, so the ids of a text are those of its chunks.
    With ``lower_words`` the tokenizer is known to lower its input and to cut letters from signs, and plain chunks go
    straight to its vocabulary; all others through the whole tokenizer. Results are the same.
    """

    def __init__(self, path: str, lower_words: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower_words = lower_words
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.first, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _ids(self, chunk: str) -> list[int]:
        if self.lower_words and (m := _PLAIN.fullmatch(chunk.lower())):
            if chunk.isascii():
                word = m[1]
            else:
                word = m[1].encode().decode("latin-1").translate(_BYTES)
            out = [t.id for t in self.tokenizer.model.tokenize(word)]
            return out + [t.id for t in self.tokenizer.model.tokenize(m[2])] if m[2] else out
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _learn(self, new: list[str]) -> None:
        ids: list[int] = []
        count = []
        for chunk in new:
            own = self._ids(chunk)
            ids += own
            count.append(len(own))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        at = len(self.ids) + np.cumsum([0, *count])[:-1]
        self.ids = np.concatenate([self.ids, np.array(ids, dtype=np.uint32)])
        self.first, self.count = np.concatenate([self.first, at]), np.concatenate([self.count, np.array(count, dtype=np.int64)])

    def encode(self, some: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.index) > CACHE:
            self.clear()
        split = [t.replace("\n", " ").split(" ") for t in some]
        index = self.index
        if new := list({c for chunks in split for c in chunks if c not in index}):
            self._learn(new)
        for chunks in split:
            at = np.array(list(map(index.__getitem__, chunks)), dtype=np.int64)
            count = self.count[at]
            ends = np.cumsum(count)
            # position in `ids`: the start of the chunk plus the distance from where the chunk begins in the text
            yield self.ids[np.repeat(self.first[at] - (ends - count), count) + np.arange(ends[-1])]


@functools.lru_cache(maxsize=1)
def tokenizer_of(path: str, lower_words: bool) -> ChunkTokenizer:
    """One tokenizer for all tasks of a Python worker."""
    return ChunkTokenizer(path, lower_words)


Piece = tuple[int, int, int]  # document of the pool, start, length


def pack_pool(lengths: list[int], tiers: tuple[int, ...], least: int) -> list[tuple[int, list[Piece]]]:
    """Windows (context, pieces) that hold documents of the given token counts, each token once."""
    top = tiers[-1]
    windows: list[tuple[int, list[Piece]]] = []
    rest: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}  # by tier: (length, document, start), ascending
    for doc, n in enumerate(lengths):
        for start in range(0, n - top + 1, top):
            windows.append((top, [(doc, start, top)]))
        if left := n % top:
            rest[tiers[bisect.bisect_left(tiers, left)]].append((left, doc, n - left))
    for own in rest.values():
        own.sort()

    def take_fitting(gap: int, below: int) -> tuple[int, int, int] | None:
        """The longest rest that fits, from this tier down."""
        for t in reversed(tiers[: below + 1]):
            if (i := bisect.bisect_right(rest[t], (gap, 1 << 62, 0))) and rest[t]:
                return rest[t].pop(i - 1)
        return None

    def put_back(piece: tuple[int, int, int]) -> None:
        bisect.insort(rest[tiers[bisect.bisect_left(tiers, piece[0])]], piece)

    tail: list[Piece] = []
    for level in range(len(tiers) - 1, -1, -1):
        size, own = tiers[level], rest[tiers[level]]
        while own:
            n, doc, start = own.pop()
            pieces, gap = [(doc, start, n)], size - n
            while gap and (more := take_fitting(gap, level)):
                pieces.append((more[1], more[2], more[0]))
                gap -= more[0]
            if gap:  # all rests are longer than the gap, or none is left
                longer = next((t for t in tiers if rest[t]), None)
                if longer is not None:
                    n2, doc2, start2 = rest[longer].pop(0)
                    pieces.append((doc2, start2, gap))
                    put_back((n2 - gap, doc2, start2 + gap))
                    gap = 0
            if gap:
                tail = pieces
            else:
                windows.append((size, pieces))
    # the end: full windows of smaller powers of two, then one padded window
    total = sum(p[2] for p in tail)
    while total:
        size = 1 << (total.bit_length() - 1) if total >= least else total
        pieces, gap = [], size
        while gap:
            doc, start, n = tail.pop(0)
            pieces.append((doc, start, min(n, gap)))
            if n > gap:
                tail.insert(0, (doc, start + gap, n - gap))
            gap -= pieces[-1][2]
        windows.append((size if size & (size - 1) == 0 else top, pieces))
        total -= size
    return windows


def step_groups(windows: list[tuple[int, list[Piece]]], tokens: int) -> list[int]:
    """A group for each window: windows by context and falling attention cost, dealt forth and back over the groups."""
    groups = max(1, -(-sum(c for c, _ in windows) // tokens))
    order = sorted(range(len(windows)), key=lambda i: (-windows[i][0], -sum(p[2] * p[2] for p in windows[i][1]), i))
    out = [0] * len(windows)
    for k, i in enumerate(order):
        turn, at = divmod(k, groups)
        out[i] = at if turn % 2 == 0 else groups - 1 - at
    return out


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, shortest: int = 512, least: int = 64, end_id: int = 2,
    pool_tokens: int = 1 << 22, step_tokens: int = 1 << 16, place: tuple[str, str] | None = None, lower_words: bool = False,
) -> DataFrame:
    """Pieces of all documents in sequences: the real ids (little-endian 32-bit), place, context size and step group.

    Each task packs pools of at least ``pool_tokens`` tokens from the partition it reads, so no row is shuffled. ``place`` names two
    columns of whole numbers, a file's and a row's: then a pool holds neighbouring rows of one file in their order, and its sequences carry the
    place of its first row as ``pool_file`` and ``pool_row``, by which sequences follow the order of the rows however files are
    dealt to tasks. A null or empty text is its end id alone. Rows with equal or null doc_id are documents of their own; further
    columns are ignored; an empty table gives no rows. Sequence ids are unique, not dense.
    """
    small_batches(docs.sparkSession)
    tiers = tuple(t for t in (1 << k for k in range(capacity.bit_length())) if shortest <= t <= capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_of(tokenizer, lower_words)
        base, groups_done = TaskContext.get().partitionId() << 40, 0
        done, pool, held, first = 0, [], 0, (0, 0)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, groups_done, pool, held
            windows = pack_pool([len(ids) for _, ids in pool], tiers, least)
            groups = step_groups(windows, step_tokens)
            rows: list[tuple] = []
            for (context, pieces), group in zip(windows, groups, strict=True):
                offset = 0
                for doc, start, n in pieces:
                    doc_id, ids = pool[doc]
                    rows.append((doc_id, start, n, ids[start : start + n].tobytes(), len(ids), base + done, offset, context, base + groups_done + group, *(first if place else ())))
                    offset += n
                done += 1
                if len(rows) >= 1000:
                    yield _piece_batch(rows)
                    rows = []
            groups_done += max(groups, default=-1) + 1
            if rows:
                yield _piece_batch(rows)
            pool, held = [], 0

        for batch in batches:
            where = zip(batch.column("file").to_pylist(), batch.column("row").to_pylist(), strict=True) if place else [(0, 0)] * batch.num_rows
            for doc_id, at, ids in zip(batch.column("doc_id").to_pylist(), where, encoder.encode(texts(batch)), strict=True):
                if pool and at[0] != first[0]:
                    yield from flush()
                if not pool:
                    first = at
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                pool.append((doc_id, ids))
                held += len(ids)
                if held >= pool_tokens:
                    yield from flush()
        yield from flush()

    if place is None:
        return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)
    file, row = (F.col(c).cast("long") for c in place)
    rows = docs.select("doc_id", "text", file.alias("file"), row.alias("row")).sortWithinPartitions("file", "row")
    return rows.mapInArrow(run, f"{PIECE_SCHEMA}, {PLACE_SCHEMA}")


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in f"{PIECE_SCHEMA}, {PLACE_SCHEMA}".split(", ")][: len(rows[0])]
    columns = [pa.array(c, pa.binary() if t == "binary" else pa.int64()) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])
