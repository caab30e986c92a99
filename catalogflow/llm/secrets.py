"""Secret scans: fixed patterns, and two character Markov models (random strings, ordinary identifiers) compared by likelihood."""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import by_batch, sample_texts, texts, words

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
_CODE = np.full(128, len(ALPHABET), dtype=np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_S = len(ALPHABET) + 1  # one more: the start of a string
# Words that identifiers are made of, beside those of the texts.
COMMON = "user name id index value count list item file path data type size key token session config error message request response handler test main get set update delete create service client server version number".split()

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, each kind leftmost and without overlaps."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    # a match is a whole run of hex digits, so runs under 16 fail and leave nothing behind
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


@dataclass
class Markov:
    """Log-likelihood ratio of second-order character transitions, random over ordinary, and the ratio a secret needs."""

    ratio: np.ndarray  # [before last, last, next]
    needed: float

    def score(self, s: str) -> float:
        codes = _CODE[np.frombuffer(s.encode("ascii"), dtype=np.uint8)]
        codes = np.concatenate([[_S - 1, _S - 1], codes])
        return float(self.ratio[codes[:-2], codes[1:-1], codes[2:]].sum())


def _log_transitions(samples: list[str]) -> np.ndarray:
    """Second-order transitions, smoothed by first-order ones, those by single characters, those by equal chances."""
    n3 = np.zeros((_S, _S, _S))
    for s in samples:
        codes = np.concatenate([[_S - 1, _S - 1], _CODE[np.frombuffer(s.encode("ascii"), dtype=np.uint8)]])
        np.add.at(n3, (codes[:-2], codes[1:-1], codes[2:]), 1)
    n2, n1 = n3.sum(0), n3.sum((0, 1))
    p1 = (n1 + 1) / (n1.sum() + _S)
    p2 = (n2 + 20 * p1) / (n2.sum(-1, keepdims=True) + 20)
    p3 = (n3 + 20 * p2) / (n3.sum(-1, keepdims=True) + 20)
    return np.log(p3)


def train(random: list[str], ordinary: list[str], prior: float = 1e-3) -> Markov:
    """Models from labelled samples. A candidate counts as random when its ratio outweighs a ``prior`` share of secrets."""
    return Markov((_log_transitions(random) - _log_transitions(ordinary)).astype(np.float32), float(np.log((1 - prior) / prior)))


def labelled_strings(text_words: list[str], n: int = 4000, seed: int = 7) -> tuple[list[str], list[str]]:
    """Labelled samples: seeded random strings over the alphabets of keys, and identifiers made of words, dates and numbers."""
    rng = np.random.default_rng(seed)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-",
                 "0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits]
    random = ["".join(rng.choice(list(alphabets[i % len(alphabets)]), int(rng.integers(16, 65)))) for i in range(n)]
    pool = sorted({w for w in text_words if w.isascii() and w.isalpha() and len(w) > 1})
    rng.shuffle(pool)
    pool = pool[:20_000] + COMMON * max(1, len(pool[:20_000]) // 60)
    ordinary = []
    for i in range(2 * n):
        some = [pool[int(k)] for k in rng.integers(0, len(pool), int(rng.integers(2, 6)))]
        number = str(int(rng.integers(0, 10 ** int(rng.integers(1, 5)))))
        style = i % 8
        s = ("_".join(some), "-".join(some), "".join(w.capitalize() for w in some), some[0] + "".join(w.capitalize() for w in some[1:]), "/".join(some),
             "_".join(some).upper(), "".join(some), "_".join([*some, number]))[style]
        ordinary.append(s if len(s) >= 16 else s + "_" + "".join(some))
    for i in range(n // 4):  # long numbers, dates, rules of one character
        digits = "".join(map(str, rng.integers(0, 10, int(rng.integers(16, 25)))))
        ordinary += [digits, f"{rng.integers(1990, 2040)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}_{digits[:6]}", "=-_+/"[i % 5] * int(rng.integers(16, 60)), pool[i % len(pool)][:1] * 20]
    return random, ordinary


def random_spans(text: str, model: Markov, taken: list[Span]) -> list[Span]:
    """Runs of key characters that the random model explains better and that no fixed span touches."""
    out: list[Span] = []
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if model.score(m[0]) > model.needed and not any(x < b and a < y for _, x, y in taken):
            out.append(("random", a, b))
    return out


def find(text: str, model: Markov) -> list[Span]:
    """All spans of a text by start, then kind."""
    base = base_spans(text)
    return sorted(base + random_spans(text, model, base), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def fit(docs: DataFrame, rows: int = 500, chars: int = 20_000) -> Markov:
    """Train from strings labelled by how they were made; identifiers use the words of at most ``rows`` sampled texts."""
    return train(*labelled_strings([w for t in sample_texts(docs, rows, chars) for w in words(t)]))


def scan(docs: DataFrame, model: Markov) -> DataFrame:
    """(doc_id, spans) with all spans of each whole text, code points with exclusive ends, in one pass without a shuffle.

    A null or empty text has none. Equal and null ids stay rows of their own; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed 1.3 MB

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t, shared.value)] for t in texts(batch)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(found, kind)], names=["doc_id", "spans"])

    return by_batch(docs.select("doc_id", "text"), run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digest_columns(found: DataFrame, base: tuple[str, ...], source: str = "spans") -> DataFrame:
    """Counts of base spans (those of kinds ``base`` in column ``source``), the hash of their list, and the list of all spans."""
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    only = F.filter(source, lambda s: s["kind"].isin(*base))
    count = lambda kind: F.size(F.filter(source, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(said(only), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
