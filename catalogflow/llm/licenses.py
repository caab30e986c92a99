"""License scans: MinHash bands over overlapping windows of a text retrieve templates, exact shingle containment verifies them.

Templates and windows are sets of five-word shingles. A window is as large as the template it is meant for: a template of L shingles, up to
``EXACT``, has windows of L shingles at every position; a longer one has windows of the next size g in 16, 24, 32, 48 and so on of which seven
eighths hold it, at every eighth of g, so that some window holds a whole match. That window has a Jaccard similarity of at least

    cL / (w + L - cL)       (c the share of the template's shingles in the match, w the window's size)

with the template, which is 0.42 for c = 0.8 in the worst case (w = 1.71 L). A window whose ``R`` minima in one of B bands equal the template's retrieves
it: with probability 1 - (1 - s ** R) ** B for similarity s, 0.997 or more at 0.42 with 32 bands. Up to ``EXACT`` shingles s is 0.67 or more
(one shingle of five may be missing), and 16 bands find 0.9999; under five shingles a match is equal and one place finds it for certain.
``collision`` gives the bound of a template. Only retrieved windows are verified: around each, the stretch in which the template's shingles go
on without a long break is compared with the template, and counts if it has ``CONTAINED`` of the template's shingles.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalogflow.llm.common import WORD, by_batch, texts
from catalogflow.llm.license_texts import TEMPLATES
from catalogflow.llm.neardup import WordHashes, _mixed

WIDTH = 5
EXACT = 12  # shingles of a template up to which windows are as large as it is
R = 2
BANDS, SHORT_BANDS = 32, 16
CONTAINED = 0.8
BREAK = 2 * WIDTH  # shingles in a row that an edit may spoil
GROUP = 3 << 13  # shingles hashed at once; a multiple of all steps
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

_rng = np.random.default_rng(11)
_XOR = _rng.integers(0, 2**63, R * BANDS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, R * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

FOUND_SCHEMA = "doc_id long, license string, start long, end long, containment double"


def shingle_hashes(words_: list[str], hashes: WordHashes) -> np.ndarray:
    """A hash for each run of five words, none for fewer."""
    w = np.array(list(map(hashes.__getitem__, words_)), dtype=np.uint64)
    n = max(len(w) - WIDTH + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WIDTH):
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    return h


def window(shingles: int) -> tuple[int, int]:
    """Size and step of the windows for a template of so many shingles."""
    if shingles <= EXACT:
        return shingles, 1
    size = 16
    while size * 7 < shingles * 8:
        size = size * 3 // 2 if size & (size - 1) == 0 else size * 4 // 3
    return size, size // 8


def bands(size: int) -> int:
    """Bands of windows of a size; one place is enough where only equal windows count."""
    return 1 if size < 5 else SHORT_BANDS if size <= EXACT else BANDS


def collision(shingles: int, contained: float = CONTAINED) -> float:
    """Least probability that a match with this share of a template's shingles retrieves the template."""
    size, _ = window(shingles)
    shared = np.ceil(contained * shingles - 1e-9)
    s = shared / (size + shingles - shared)
    return float(s if size < 5 else 1 - (1 - s**R) ** bands(size))


def values(h: np.ndarray, places: int) -> np.ndarray:
    """The value of each shingle at each place [place, shingle]; a set's minimum there is its MinHash."""
    with np.errstate(over="ignore"):
        return (h[None] ^ _XOR[:places, None]) * _ODD[:places, None]


def band_key(minima: np.ndarray, band: int, size: int) -> np.ndarray:
    """The key of a band of MinHashes [place, window]."""
    if size < 5:
        return minima[0]
    with np.errstate(over="ignore"):
        return _mixed(minima[R * band] * np.uint64(0x9E3779B97F4A7C15) + minima[R * band + 1])


@dataclass
class Retrieval:
    """The templates of one window size: by band, their keys in order, who has them, and which leading bits occur."""

    size: int
    step: int
    keys: list[np.ndarray]
    owners: list[np.ndarray]
    some: np.ndarray

    def hits(self, minima: np.ndarray) -> set[tuple[int, int]]:
        """(window, template) of the windows that retrieve a template."""
        out: set[tuple[int, int]] = set()
        for b, (keys, owners) in enumerate(zip(self.keys, self.owners, strict=True)):
            own = band_key(minima, b, self.size)
            for at in np.flatnonzero(self.some[b][own >> np.uint64(48)]).tolist():
                first, last = np.searchsorted(keys, own[at], "left"), np.searchsorted(keys, own[at], "right")
                out.update((at, int(t)) for t in owners[first:last])
        return out


@dataclass
class Index:
    """Templates: their shingles, and how windows of each size retrieve them."""

    names: list[str]
    own: list[np.ndarray]
    sizes: list[Retrieval]


def index(templates: dict[str, str]) -> Index:
    """The index of templates, each of five words at least."""
    hashes = WordHashes()
    names = sorted(templates)
    own = [np.unique(shingle_hashes(WORD.findall(templates[n].lower()), hashes)) for n in names]
    if short := [n for n, h in zip(names, own, strict=True) if not len(h)]:
        raise ValueError(f"templates need five words: {short}")
    by_size: dict[tuple[int, int], list[int]] = defaultdict(list)
    for t, h in enumerate(own):
        by_size[window(len(h))].append(t)
    sizes = []
    for (size, step), members in sorted(by_size.items()):
        minima = np.stack([values(own[t], R * bands(size)).min(1) for t in members], axis=1)
        keys, owners, some = [], [], np.zeros((bands(size), 1 << 16), dtype=bool)
        for b in range(bands(size)):
            key = band_key(minima, b, size)
            order = np.argsort(key)
            keys.append(key[order])
            owners.append(np.array(members)[order])
            some[b, key >> np.uint64(48)] = True
        sizes.append(Retrieval(size, step, keys, owners, some))
    return Index(names, own, sizes)


def sliding(v: np.ndarray, width: int) -> np.ndarray:
    """Minima of ``width`` neighbouring columns, for every column that has so many from it on."""
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:, :-have], v[:, have:])
        have *= 2
    return np.minimum(v[:, : v.shape[1] - (width - have)], v[:, width - have :]) if have < width else v


def retrieved(parts: list[np.ndarray], ix: Index) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Windows (start, end) that retrieve a template, by part and template. Windows at the end of a part may be shorter."""
    out: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    length = np.array([len(p) for p in parts], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(length)])
    if not start[-1]:
        return out
    every = values(np.concatenate(parts), R * max(bands(r.size) for r in ix.sizes))
    for r in ix.sizes:
        pad = r.size // r.step - 1  # empty columns after each part
        count = -(-length // r.step)  # columns of each part, and where they begin without and with empty ones
        bare = np.concatenate([[0], np.cumsum(count)])
        first = bare + pad * np.arange(len(parts) + 1)
        number = np.arange(bare[-1])
        part = np.repeat(np.arange(len(parts)), count)
        v = every[: 1 if r.size < 5 else R * bands(r.size)]
        if r.step > 1:
            v = np.minimum.reduceat(v, start[part] + (number - bare[part]) * r.step, axis=1)
        columns = np.full((len(v), int(first[-1])), NONE)
        columns[:, number + pad * part] = v
        for at, t in r.hits(sliding(columns, r.size // r.step)):
            i = int(np.searchsorted(first, at, "right")) - 1
            begin = (at - int(first[i])) * r.step
            if begin < length[i]:
                out[i, t].append((begin, min(begin + r.size, int(length[i]))))
    return out


def verified(h: np.ndarray, own: np.ndarray, windows: list[tuple[int, int]], size: int) -> list[tuple[int, int, float]]:
    """(first shingle, last shingle, containment) of the stretches around retrieved windows that hold enough of a template."""
    stretches: list[list[int]] = []
    for start, end in sorted(windows):
        low, high = max(start - size, 0), min(end + size, len(h))
        if stretches and low <= stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], high)
        else:
            stretches.append([low, high])
    out = []
    for low, high in stretches:
        hits = low + np.flatnonzero(np.isin(h[low:high], own))
        for run in np.split(hits, np.flatnonzero(np.diff(hits) > BREAK) + 1) if len(hits) else []:
            share = len(np.unique(h[run])) / len(own)
            if share >= CONTAINED and any(start <= run[-1] and run[0] < end for start, end in windows):
                out.append((int(run[0]), int(run[-1]), share))
    return out


def matches(some: list[str], ix: Index, hashes: WordHashes) -> list[list[tuple[str, int, int, float]]]:
    """(license, start, end, containment) of the verified matches of each text, in code points."""
    low = [t.lower() for t in some]
    h = [shingle_hashes(WORD.findall(t), hashes) for t in low]
    longest = max(r.size for r in ix.sizes)
    where: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)  # (text, template) -> retrieved windows
    group: list[tuple[int, int, np.ndarray]] = []

    def flush() -> None:
        for (i, t), found in retrieved([p for _, _, p in group], ix).items():
            d, at, _ = group[i]
            where[d, t] += [(at + a, at + b) for a, b in found]
        group.clear()

    for d, own in enumerate(h):
        for at in range(0, len(own), GROUP):  # a long text in parts that share the longest window
            group.append((d, at, own[at : at + GROUP + longest]))
            if sum(len(p) for _, _, p in group) >= GROUP:
                flush()
    flush()
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in some]
    spans: dict[int, list[tuple[int, int]]] = {}
    for (d, t), found in sorted(where.items()):
        for first, last, share in verified(h[d], ix.own[t], found, window(len(ix.own[t]))[0]):
            if d not in spans:
                spans[d] = [m.span() for m in WORD.finditer(some[d] if len(low[d]) == len(some[d]) else low[d])]
            out[d].append((ix.names[t], spans[d][first][0], spans[d][last + WIDTH - 1][1], share))
    return out


def find(text: str, ix: Index, hashes: WordHashes) -> list[tuple[str, int, int, float]]:
    """(license, start, end, containment) of the verified matches of one text."""
    return matches([text], ix, hashes)[0]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, start, end, containment): every match of a template in every whole text, in one pass without a shuffle.

    Places are code points of the text (of its lower-case form, where that has another length). Null, empty and short texts
    have no match. Repeated and null ids give their rows again, further columns are ignored, an empty table gives no rows.
    """
    ix = index(templates or TEMPLATES)
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = matches(texts(batch), ix, hashes)
        rows = [(d, *x) for d, own in zip(batch.column("doc_id").to_pylist(), found, strict=True) for x in own]
        if not rows:
            return None
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.split()[0] for f in FOUND_SCHEMA.split(", ")])

    return by_batch(docs.select("doc_id", "text"), run, FOUND_SCHEMA)
