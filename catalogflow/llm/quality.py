"""Document quality: random-indexing word vectors over the whole corpus, pooled per document, and a small calibrated network.

Each word (a run between white space, as written) and each word shape has a sparse random index vector, derived from its
hash bucket. Its context vector is the sum of the index vectors around it in all texts: whole numbers, so the sum is the
same in any order. A document is the mean of its words' unit context vectors and of its shapes', with the lengths of both
means and its word count.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalogflow.llm.common import by_batch, learning_rows, remainder, small_batches, texts
from catalogflow.llm.nets import Adam, Params, constant_logit, sigmoid, temperature

WORDS, SHAPES, DIM = 1 << 14, 1 << 10, 48  # buckets and dimensions: the table of vectors has a fixed size of 3.3 MB
ROWS = WORDS + SHAPES
CACHE = 300_000  # words whose buckets a task remembers
CHUNK = 100_000  # words of documents pooled at once
_SHAPE = [(re.compile("[a-z]+"), "a"), (re.compile("[A-Z]+"), "A"), (re.compile("[0-9]+"), "9"), (re.compile(r"[^\W\d_a-zA-Z]+"), "a"), (re.compile(r"(.)\1+"), r"\1\1")]


def shape(word: str) -> str:
    """A word by its kinds of characters: runs of small letters a, capitals A, digits 9, repeated signs twice."""
    for pattern, to in _SHAPE:
        word = pattern.sub(to, word)
    return word[:8]


class Buckets(dict):
    """Word -> word bucket * SHAPES + shape bucket, computed when first met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        code = zlib.crc32(word.encode()) % WORDS * SHAPES + zlib.crc32(shape(word).encode()) % SHAPES
        self[word] = code
        return code

    def of(self, text: str) -> np.ndarray:
        return np.array(list(map(self.__getitem__, text.split())), dtype=np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the two non-zero entries of each bucket's index vector; the last row is an empty one."""
    rng = np.random.default_rng(11)
    place = rng.integers(0, DIM, (ROWS + 1, 2))
    sign = rng.choice([-1.0, 1.0], (ROWS + 1, 2))
    sign[ROWS] = 0
    return place, sign


def context_sums(sequences: list[np.ndarray], place: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Sums of the index vectors one and two words before and after, for the buckets of some documents."""
    gap = np.full(2, ROWS, dtype=np.int64)
    ids = np.concatenate([x for s in sequences for x in (s, gap)])
    out = np.zeros((ROWS + 1) * DIM)
    for distance in (1, 2):
        for at, near in ((ids[:-distance], ids[distance:]), (ids[distance:], ids[:-distance])):
            for k in (0, 1):
                out += np.bincount(at * DIM + place[near, k], weights=sign[near, k], minlength=len(out))
    return out.reshape(-1, DIM)[:ROWS]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all buckets from every text: one pass, a row for each bucket and task, summed in Spark."""
    small_batches(docs.sparkSession)
    names = [f"c{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        buckets, sums, held, n = Buckets(), np.zeros((ROWS, DIM)), [], 0
        for batch in batches:
            for text in texts(batch):
                code = buckets.of(text)
                held += [code // SHAPES, WORDS + code % SHAPES]
                n += len(code)
                if n > 500_000:
                    sums += context_sums(held, place, sign)
                    held, n = [], 0
        if held:
            sums += context_sums(held, place, sign)
        used = np.flatnonzero(np.abs(sums).sum(1))
        if len(used):
            columns = [pa.array(used.astype(np.int32))] + [pa.array(sums[used, i].astype(np.int64)) for i in range(DIM)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", *names])

    sums = docs.select("text").mapInArrow(run, "bucket int, " + ", ".join(f"{n} long" for n in names))
    got = sums.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # at most ROWS rows
    out = np.zeros((ROWS, DIM), dtype=np.float32)
    if got.num_rows:
        out[got["bucket"].to_numpy()] = np.column_stack([got[n].to_numpy() for n in names])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pooled(some: list[str], vectors: np.ndarray, buckets: Buckets) -> np.ndarray:
    """Features of texts: both mean vectors, their lengths, and the logarithm of the word count. Empty texts have zeros."""
    out = np.zeros((len(some), 2 * DIM + 3), dtype=np.float32)
    for i, text in enumerate(some):
        code = buckets.of(text)
        if len(code):
            word, form = np.zeros(DIM), np.zeros(DIM)
            for at in range(0, len(code), CHUNK):
                part = code[at : at + CHUNK]
                word += vectors[part // SHAPES].sum(0, dtype=np.float64)
                form += vectors[WORDS + part % SHAPES].sum(0, dtype=np.float64)
            word, form = word / len(code), form / len(code)
            out[i] = np.concatenate([word, form, [np.linalg.norm(word), np.linalg.norm(form), np.log1p(len(code))]])
    return out


def learning_features(rows: DataFrame, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of labelled texts (doc_id, text, y) by id and text. The texts stay in the tasks; the driver gets 400 bytes for each."""
    shared = rows.sparkSession.sparkContext.broadcast(vectors)  # a fixed size
    buckets = Buckets()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [row.tobytes() for row in pooled(texts(batch), shared.value, buckets)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), batch.column("y"), pa.array(x, pa.binary())], names=["doc_id", "k", "y", "x"])

    numbered = rows.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("text")).alias("k"), "y", "text")
    got = by_batch(numbered, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k int, y int, x binary").toArrow().to_pydict()
    order = sorted(range(len(got["y"])), key=lambda i: (got["doc_id"][i], got["k"][i]))
    x = np.frombuffer(b"".join(got["x"][i] for i in order), dtype=np.float32).reshape(-1, 2 * DIM + 3)
    return x, np.array([got["y"][i] for i in order], dtype=np.float32)


@dataclass
class Quality:
    """The trained classifier: word vectors, feature scale, weights, temperature."""

    vectors: np.ndarray
    params: Params = field(default_factory=dict)
    mean: np.ndarray | float = 0.0
    scale: np.ndarray | float = 1.0
    heat: float = 1.0
    fixed: float | None = None  # the logit when there was nothing to learn from

    def logits(self, x: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        p = self.params
        return np.tanh((x - self.mean) / self.scale @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.heat).astype(np.float64)


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 3) -> Quality:
    """Fit the two layers on four fifths of the rows and the temperature on the rest."""
    rest = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~rest])) < 2:
        return Quality(vectors, fixed=constant_logit(y))
    rng = np.random.default_rng(seed)
    mean, scale = x[~rest].mean(0), x[~rest].std(0) + 1e-3
    p = {"w1": rng.normal(0, 0.1, (x.shape[1], hidden)), "b1": np.zeros(hidden), "w2": rng.normal(0, 0.1, hidden), "b2": np.zeros(())}
    model, adam = Quality(vectors, p, mean, scale), Adam(p, 0.003, decay=1e-4)
    a, b = (x[~rest] - mean) / scale, y[~rest]
    for _ in range(epochs):
        order = rng.permutation(len(b))
        for at in range(0, len(b), 64):
            i = order[at : at + 64]
            h = np.tanh(a[i] @ p["w1"] + p["b1"])
            d = (sigmoid(h @ p["w2"] + p["b2"]) - b[i]) / len(i)
            back = d[:, None] * p["w2"] * (1 - h * h)
            adam.step({"w1": a[i].T @ back, "b1": back.sum(0), "w2": h.T @ d, "b2": d.sum()})
    model.heat = temperature(model.logits(x[rest]), y[rest])
    return model


def fit(docs: DataFrame, labels: DataFrame, divisor: int = 4, held_out: int = 2, rows: int = 8000, chars: int = 50_000) -> Quality:
    """Word vectors from every text, and the network from at most ``rows`` labelled texts of at most ``chars`` characters."""
    vectors = word_vectors(docs)
    return train(*learning_features(learning_rows(docs, labels, "quality", divisor, held_out, rows, chars), vectors), vectors)


def score(docs: DataFrame, model: Quality, threshold: float = 0.7, keep: bool = False) -> DataFrame:
    """(doc_id, score, predicted) of every whole text, or with ``keep`` all columns and ``quality_score``.

    A null or empty text has the score of zero features. Repeated and null ids stay rows of their own, further columns
    are ignored or kept, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size
    buckets = Buckets()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = shared.value.score(pooled(texts(batch), shared.value.vectors, buckets))
        if keep:
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*batch.schema.names, "quality_score"])
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    if keep:
        return by_batch(docs, run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", quality_score double")
    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")


def held(scored: DataFrame, divisor: int = 4, rest: int = 2) -> DataFrame:
    """With the column that tells which rows were kept from learning."""
    return scored.select("doc_id", (remainder(F.col("doc_id"), divisor) == rest).alias("held_out"), "score", "predicted")
