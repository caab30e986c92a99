"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy.

A word is the sum of two learned parts: an embedding, if it is one of the frequent words of the learning texts (the first
coordinate starts at the word's class log-odds there), beside the mean embedding of its hashed character triples and
beginnings (of which the first coordinate starts at their log-odds likewise). Windows
of ``T`` words overlap by half and cover every word of a text; a text's score is a logistic fit of its worst window's logit,
its windows' mean logit and the logarithm of their number. The network learns from the worst window of each toxic text
and from random and worst windows of the others.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import WORD, by_batch, learning_texts, remainder, texts
from catalogflow.llm.nets import Adam, Params, constant_logit, logistic, sigmoid

T, STEP = 32, 16  # words in a window, and from one window to the next
E, H, LONGEST = 8, 8, 24  # sizes: each embedding, each direction, triples read of a word's start and end
TRIPLES, BEGINNINGS, LENGTHS = 2048, 8192, (4, 5, 6, 7)  # buckets of character triples and of a word's beginnings
PIECES = TRIPLES + BEGINNINGS
VOCABULARY = 20_000
CACHE = 150_000  # distinct words whose inputs a task remembers
BLOCK = 2048  # windows run, or words read, at once


def pieces(word: str) -> list[int]:
    """Buckets of the character triples of a word (of a very long word those of both ends) and of its beginnings."""
    w = f"<{word}>"
    n = len(w) - 2
    at = range(n) if n <= LONGEST else [*range(LONGEST // 2), *range(n - LONGEST // 2, n)]
    starts = [TRIPLES + zlib.crc32(word[:n].encode()) % BEGINNINGS for n in LENGTHS if len(word) >= n]
    return [zlib.crc32(w[i : i + 3].encode()) % TRIPLES for i in at] + starts


@dataclass
class Toxicity:
    """Weights, the vocabulary and the calibration."""

    index: dict[str, int] = field(default_factory=dict)  # word -> row of the embedding; 0 is any other word
    params: Params = field(default_factory=dict)
    calibration: np.ndarray | None = None  # for (worst logit, mean logit, log of windows, 1)
    fixed: float | None = None

    def inputs(self, some: list[str]) -> np.ndarray:
        """Word and character parts of words."""
        p, out = self.params, np.zeros((len(some), 2 * E), dtype=np.float32)
        for at in range(0, len(some), BLOCK):
            part = some[at : at + BLOCK]
            lists = [pieces(w) for w in part]
            count = np.array([len(x) for x in lists])
            flat = np.concatenate([np.array(x, dtype=np.int64) for x in lists])
            out[at : at + BLOCK, :E] = p["words"][[self.index.get(w, 0) for w in part]]
            out[at : at + BLOCK, E:] = np.add.reduceat(p["chars"][flat], np.concatenate([[0], np.cumsum(count)[:-1]])) / count[:, None]
        return out


def _gates(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the gated unit: x has the input's part of update, reset and new state."""
    zr = 1 / (1 + np.exp(-(x[:, : 2 * H] + h @ u[:, : 2 * H])))
    z, r = zr[:, :H], zr[:, H:]
    un = h @ u[:, 2 * H :]
    n = np.tanh(x[:, 2 * H :] + r * un)
    return z, r, un, n, n + z * (h - n)


def window_logits(projected: np.ndarray, ids: np.ndarray, p: Params) -> np.ndarray:
    """Logits of windows. ``projected`` has both directions' input parts by word, its last row the empty word; ids end with that row's number as padding."""
    pad, out = len(projected) - 1, np.zeros(len(ids), dtype=np.float32)
    for at in range(0, len(ids), BLOCK):
        w = ids[at : at + BLOCK]
        hidden = np.zeros((T, len(w), 2 * H), dtype=np.float32)
        for side, steps in ((0, range(T)), (1, range(T - 1, -1, -1))):
            h = np.zeros((len(w), H), dtype=np.float32)
            part = projected[:, side * 3 * H : (side + 1) * 3 * H]
            for t in steps:
                h = _gates(part[w[:, t]], h, p["u0" if side == 0 else "u1"])[-1]
                hidden[t, :, side * H : (side + 1) * H] = h
        a = np.tanh(hidden @ p["wa"]) @ p["va"]
        a[w.T == pad] = -1e9
        a = np.exp(a - a.max(0))
        pooled = np.einsum("tb,tbh->bh", a / a.sum(0), hidden)
        out[at : at + BLOCK] = np.tanh(pooled @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
    return out


def project(x: np.ndarray, p: Params) -> np.ndarray:
    """Both directions' input parts of words, and of the empty word at the end."""
    x = np.vstack([x, np.zeros((1, x.shape[1]), dtype=np.float32)])
    return np.hstack([x @ p["w0_in"] + p["b0"], x @ p["w1_in"] + p["b1_in"]]).astype(np.float32)


def windows(n: int) -> np.ndarray:
    """Starts of the overlapping windows that cover n words: one window at least."""
    return np.arange(0, max(n - STEP, 1), STEP)


def window_ids(ids: np.ndarray, pad: int) -> np.ndarray:
    """Word numbers of each window of a text."""
    starts = windows(len(ids))
    padded = np.concatenate([ids, np.full(T, pad, dtype=ids.dtype)])
    return padded[starts[:, None] + np.arange(T)]


def _loss_gradients(p: Params, words_: np.ndarray, char_ids: np.ndarray, char_n: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Params:
    """Gradients of the weighted log loss of a batch of windows. ``words_``: embedding rows, -1 as padding."""
    b = len(y)
    pad = words_ < 0
    x = np.concatenate([p["words"][words_], p["chars"][char_ids].sum(2) / char_n[..., None]], axis=2)
    x[pad] = 0
    sides, hidden = [], np.zeros((b, T, 2 * H))
    for side, steps in ((0, range(T)), (1, range(T - 1, -1, -1))):
        part = x @ p[f"w{side}_in"] + p["b0" if side == 0 else "b1_in"]
        h, kept = np.zeros((b, H)), {}
        for t in steps:
            before = h
            z, r, un, n, h = _gates(part[:, t], before, p[f"u{side}"])
            kept[t] = (before, z, r, un, n)
            hidden[:, t, side * H : (side + 1) * H] = h
        sides.append((side, steps, kept))
    q = np.tanh(hidden @ p["wa"])
    a = q @ p["va"]
    a[pad] = -1e9
    a = np.exp(a - a.max(1, keepdims=True))
    a /= a.sum(1, keepdims=True)
    pooled = np.einsum("bt,bth->bh", a, hidden)
    k = np.tanh(pooled @ p["w1"] + p["b1"])
    d = (sigmoid(k @ p["w2"] + p["b2"]) - y) * weight / weight.sum()
    g: Params = {"w2": k.T @ d, "b2": d.sum()}
    dk = d[:, None] * p["w2"] * (1 - k * k)
    g["w1"], g["b1"] = pooled.T @ dk, dk.sum(0)
    dpool = dk @ p["w1"].T
    da = np.einsum("bh,bth->bt", dpool, hidden)
    da = a * (da - (a * da).sum(1, keepdims=True))
    g["va"] = np.einsum("bt,btk->k", da, q)
    dq = da[..., None] * p["va"] * (1 - q * q)
    g["wa"] = np.einsum("bth,btk->hk", hidden, dq)
    dhidden = a[..., None] * dpool[:, None] + dq @ p["wa"].T
    dx = np.zeros_like(x)
    for side, steps, kept in sides:
        u, du, dh = p[f"u{side}"], np.zeros_like(p[f"u{side}"]), np.zeros((b, H))
        dpart = np.zeros((b, T, 3 * H))
        for t in reversed(steps):
            before, z, r, un, n = kept[t]
            dh = dh + dhidden[:, t, side * H : (side + 1) * H]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            dpart[:, t] = np.hstack([dz, dr, dn])
            inner = np.hstack([dz, dr, dn * r])
            du += before.T @ inner
            dh = dh * z + inner @ u.T
        g[f"u{side}"] = du
        g[f"w{side}_in"] = np.einsum("bti,btj->ij", x, dpart)
        g["b0" if side == 0 else "b1_in"] = dpart.sum((0, 1))
        dx += dpart @ p[f"w{side}_in"].T
    dx[pad] = 0
    g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
    np.add.at(g["words"], words_[~pad], dx[..., :E][~pad])
    share = np.repeat((dx[..., E:] / char_n[..., None])[:, :, None], char_ids.shape[2], axis=2)
    np.add.at(g["chars"], char_ids.reshape(-1), share.reshape(-1, E))
    g["chars"][-1] = 0  # the padding of the pieces
    return g


def train(some: list[str], y: np.ndarray, epochs: int = 12, seed: int = 5) -> Toxicity:
    """Fit the network on four fifths of the texts and the calibration on the rest."""
    rest = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~rest])) < 2:
        return Toxicity(fixed=constant_logit(y))
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in WORD.findall(t.lower())], dtype=np.int32) for t in some]
    vocabulary = list(number)
    seen, toxic = (np.zeros(len(vocabulary), dtype=np.int64) for _ in range(2))  # texts with a word
    for x, label, r in zip(ids, y, rest, strict=True):
        if not r:
            seen[own := np.unique(x)] += 1
            toxic[own] += int(label)
    frequent = [vocabulary[i] for i in sorted(np.flatnonzero(seen > 1), key=lambda i: (-seen[i], vocabulary[i]))[:VOCABULARY]]
    bad, good = float(y[~rest].sum()), float((1 - y[~rest]).sum())
    log_odds = lambda t, n: np.log((t + 0.5) / (bad + 1)) - np.log((n - t + 0.5) / (good + 1))
    common = np.array([number[w] for w in frequent], dtype=np.int64)
    odds = log_odds(toxic[common], seen[common])
    model = Toxicity({w: i + 1 for i, w in enumerate(frequent)})
    p = {"words": rng.normal(0, 0.05, (len(frequent) + 1, E)), "chars": rng.normal(0, 0.05, (PIECES + 1, E))}
    p["words"][1:, 0] = np.clip(odds, -2, 4)
    p["chars"][-1] = 0
    lists = [pieces(w) for w in vocabulary]
    starts = np.zeros((2, PIECES))  # texts with a beginning: toxic ones, all
    for x, label, r in zip(ids, y, rest, strict=True):
        if not r:
            own = list({b for i in np.unique(x) for b in lists[i] if b >= TRIPLES})
            starts[1, own] += 1
            starts[0, own] += label
    p["chars"][:PIECES, 0] += np.where(starts[1] > 2, 2 * np.clip(log_odds(*starts), -1, 4), 0)
    for side in (0, 1):
        p |= {f"w{side}_in": rng.normal(0, 0.3, (2 * E, 3 * H)), f"u{side}": rng.normal(0, 0.3, (H, 3 * H))}
    p |= {"b0": np.zeros(3 * H), "b1_in": np.zeros(3 * H), "wa": rng.normal(0, 0.3, (2 * H, H)), "va": rng.normal(0, 0.3, H),
          "w1": rng.normal(0, 0.3, (2 * H, H)), "b1": np.zeros(H), "w2": rng.normal(0, 0.3, H), "b2": np.zeros(())}
    model.params = p

    char_ids = np.full((len(vocabulary) + 1, LONGEST + len(LENGTHS)), PIECES, dtype=np.int32)
    for i, x in enumerate(lists):
        char_ids[i, : len(x)] = x
    char_n = np.array([max(len(x), 1) for x in lists] + [1], dtype=np.float64)
    del lists
    row = np.array([model.index.get(w, 0) for w in vocabulary] + [-1])
    win = [window_ids(x, len(vocabulary)) for x in ids]
    learn = np.flatnonzero(~rest)
    lift = np.append([odds[model.index[w] - 1] if w in model.index else 0.0 for w in vocabulary], -9)
    worst = {i: int(lift[win[i]].max(1).argmax()) for i in learn}
    adam = Adam(p, 0.004)
    for epoch in range(epochs):
        if epoch and epoch % 3 == 0:  # where the network itself sees the worst window
            projected = project(model.inputs(vocabulary), p)
            logit = window_logits(projected, np.vstack([win[i] for i in learn]), {k: v.astype(np.float32) for k, v in p.items()})
            ends = np.cumsum([len(win[i]) for i in learn])
            worst = {i: int(part.argmax()) for i, part in zip(learn, np.split(logit, ends[:-1]), strict=True)}
        picks = [(i, worst[i]) for i in learn] + [(i, int(rng.integers(len(win[i])))) for i in learn if not y[i]]
        picks = [picks[k] for k in rng.permutation(len(picks))]
        for at in range(0, len(picks), 64):
            w = np.stack([win[i][k] for i, k in picks[at : at + 64]])
            label = np.array([y[i] for i, _ in picks[at : at + 64]], dtype=np.float64)
            rows_ = row[w]  # a third of the words is hidden, so that the characters must tell as well
            rows_ = np.where((rows_ > 0) & (rng.random(rows_.shape) < 0.35), 0, rows_)
            adam.step(_loss_gradients(p, rows_, char_ids[w], char_n[w], label, np.where(label > 0, min(good / bad, 4.0), 1.0)))
    model.params = {k: np.asarray(v, dtype=np.float32) for k, v in p.items()}
    projected = project(model.inputs(vocabulary), model.params)
    held = np.flatnonzero(rest) if len(np.unique(y[rest])) == 2 else np.arange(len(y))
    model.calibration = logistic(_summary([window_logits(projected, win[i], model.params) for i in held]), y[held].astype(np.float64))
    return model


def _summary(logits: list[np.ndarray]) -> np.ndarray:
    """What the calibration sees of the windows of each text."""
    return np.array([[x.max(), x.mean(), np.log(len(x))] for x in logits])


class Scorer:
    """Scores texts with a memory of the inputs of words met before."""

    def __init__(self, model: Toxicity):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.projected = np.zeros((0, 6 * H), dtype=np.float32)

    def __call__(self, some: list[str]) -> np.ndarray:
        m = self.model
        if m.fixed is not None:
            return np.full(len(some), float(sigmoid(np.array(m.fixed))))
        out, at = np.zeros(len(some)), 0
        while at < len(some):  # texts of some 100,000 words together
            split, n, start = [], 0, at
            while at < len(some) and n < 100_000:
                split.append(WORD.findall(some[at].lower()))
                n += len(split[-1])
                at += 1
            out[start:at] = self.logits(split)
        return sigmoid(out).astype(np.float64)

    def logits(self, split: list[list[str]]) -> np.ndarray:
        if len(self.number) > CACHE:
            self.clear()
        new = list({w for s in split for w in s if w not in self.number})
        if new or not len(self.projected):
            own = project(self.model.inputs(new), self.model.params)
            self.projected = np.vstack([self.projected[:-1], own])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        pad = len(self.projected) - 1
        win = [window_ids(np.array(list(map(self.number.__getitem__, s)), dtype=np.int64), pad) for s in split]
        logit = window_logits(self.projected, np.vstack(win), self.model.params)
        count = np.array([len(w) for w in win])
        seen = _summary(np.split(logit, np.cumsum(count)[:-1]))
        return np.column_stack([seen, np.ones(len(count))]) @ self.model.calibration


def fit(docs: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0, rows: int = 5000, chars: int = 20_000) -> Toxicity:
    """Learn from at most ``rows`` labelled texts of at most ``chars`` characters."""
    return train(*learning_texts(docs, labels, "toxic", divisor, held_out, rows, chars))


def score(docs: DataFrame, model: Toxicity, divisor: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text, in one pass without a shuffle.

    A null or empty text has one empty window. Repeated and null ids stay rows of their own, further columns are ignored,
    an empty table gives no rows. Without labels of both classes every text gets the share of toxic labels.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY
    scorer: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scorer:
            scorer.append(Scorer(shared.value))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scorer[0](texts(batch)))], names=["doc_id", "score"])

    scored = by_batch(docs.select("doc_id", "text"), run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
