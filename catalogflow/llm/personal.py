"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions in numpy.

The network reads overlapping windows of ``T`` characters. Every span of the four kinds holds a digit or an at sign, so a
window without one has no span and is not run. The best tag path of each window gives spans with the mean posterior of
their tags; a span cut by a window's edge is left to the next window. Over a whole text the spans of all windows are
reconciled together: of those that overlap, the set of the greatest total posterior and length stays.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalogflow.llm.common import by_batch, sample_texts, texts, words
from catalogflow.llm.nets import Adam, Params, sigmoid

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
T, STEP = 64, 32
E, H = 10, 14
BLOCK = 1024  # windows run at once
SURE = 0.9  # mean posterior that a span of the network needs
CHARS = 130  # ASCII, other letters, other characters
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRACE = re.compile("[0-9@]")
_DIGITS = str.maketrans("", "", "".join(map(chr, [*range(48), *range(58, 128)])))

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """At each at sign, the run of name characters before it (not of the address before) and the dotted name after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
        end = max(end, 0)
    return out


def _part(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) <= 3 and int(p or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, each kind leftmost and without overlaps, by kind and start."""
    if not _TRACE.search(text):
        return []
    out: list[Span] = [("email", *s) for s in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_part, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].translate(_DIGITS)
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(m[0].translate(_DIGITS)) <= 15]


def codes(text: str) -> np.ndarray:
    """Characters as small numbers."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(c < 128, c, np.where((c < 0x2000) | (c > 0x2FFF), 128, 129)).astype(np.int64)


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an at sign."""
    last = max(0, -(-(len(text) - T) // STEP))
    hit: set[int] = set()
    for m in _TRACE.finditer(text):
        k = m.start() // STEP
        hit.update(j for j in range(max(0, k - T // STEP + 1), min(k, last) + 1))
    return [j * STEP for j in sorted(hit)]


# --- network ---------------------------------------------------------------------------------------------------------


def _cell(x: np.ndarray, h: np.ndarray, c: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    a = x + h @ u
    ifo = 1 / (1 + np.exp(-a[:, : 3 * H]))
    i, f, o, g = ifo[:, :H], ifo[:, H : 2 * H], ifo[:, 2 * H :], np.tanh(a[:, 3 * H :])
    c2 = f * c + i * g
    tc = np.tanh(c2)
    return i, f, o, g, c2, tc, o * tc


def emissions(p: Params, ids: np.ndarray) -> np.ndarray:
    """Tag scores [time, window, tag]. ids: [window, time], CHARS where the text has ended."""
    hidden = np.zeros((T, len(ids), 2 * H), dtype=p["out"].dtype)
    for side, steps in ((0, range(T)), (1, range(T - 1, -1, -1))):
        part = p["chars"] @ p[f"w{side}"] + p[f"b{side}"]
        h = c = np.zeros((len(ids), H), dtype=p["out"].dtype)
        for t in steps:
            *_, c, _, h = _cell(part[ids[:, t]], h, c, p[f"u{side}"])
            hidden[t, :, side * H : (side + 1) * H] = h
    return hidden @ p["out"] + p["bias"]


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def _forward_backward(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, T):
        alpha[t] = e[t] + _sum_exp(alpha[t - 1][:, :, None] + trans, 1)
    for t in range(T - 2, -1, -1):
        beta[t] = _sum_exp(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    return alpha, beta, _sum_exp(alpha[-1], 1)


def _gradients(p: Params, ids: np.ndarray, tags: np.ndarray) -> Params:
    """Gradients of the mean negative log-likelihood of tag paths."""
    b = len(ids)
    hidden, sides = np.zeros((T, b, 2 * H)), []
    for side, steps in ((0, range(T)), (1, range(T - 1, -1, -1))):
        part = p["chars"] @ p[f"w{side}"] + p[f"b{side}"]
        h = c = np.zeros((b, H))
        kept = {}
        for t in steps:
            before = (h, c)
            i, f, o, g, c, tc, h = _cell(part[ids[:, t]], h, c, p[f"u{side}"])
            kept[t] = (*before, i, f, o, g, tc)
            hidden[t, :, side * H : (side + 1) * H] = h
        sides.append((side, steps, kept))
    e = hidden @ p["out"] + p["bias"]
    alpha, beta, z = _forward_backward(e, p["trans"])
    de = np.exp(alpha + beta - z[:, None])
    dtrans = np.zeros_like(p["trans"])
    for t in range(1, T):
        dtrans += np.exp(alpha[t - 1][:, :, None] + p["trans"] + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        np.add.at(dtrans, (tags[:, t - 1], tags[:, t]), -1)
    de[np.arange(T)[:, None], np.arange(b)[None, :], tags.T] -= 1
    de /= b
    g: Params = {"trans": dtrans / b, "bias": de.sum((0, 1)), "out": np.einsum("tbh,tbk->hk", hidden, de), "chars": np.zeros_like(p["chars"])}
    dhidden = de @ p["out"].T
    for side, steps, kept in sides:
        u, w = p[f"u{side}"], p[f"w{side}"]
        du, dpart = np.zeros_like(u), np.zeros((len(p["chars"]), 4 * H))
        dh, dc = np.zeros((b, H)), np.zeros((b, H))
        for t in reversed(steps):
            h0, c0, i, f, o, gg, tc = kept[t]
            dh = dh + dhidden[t, :, side * H : (side + 1) * H]
            dc = dc + dh * o * (1 - tc * tc)
            da = np.hstack([dc * gg * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - gg * gg)])
            du += h0.T @ da
            np.add.at(dpart, ids[:, t], da)
            dh, dc = da @ u.T, dc * f
        g[f"u{side}"], g[f"b{side}"], g[f"w{side}"] = du, dpart.sum(0), p["chars"].T @ dpart
        g["chars"] += dpart @ w.T
    return g


@dataclass
class Tagger:
    """Trained weights."""

    params: Params

    def decode(self, ids: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """(kind number, start, end, mean posterior) of the best path of each window."""
        e = emissions(self.params, ids)
        trans = self.params["trans"]
        best, back = e[0], []
        for t in range(1, T):
            s = best[:, :, None] + trans
            back.append(s.argmax(1))
            best = s.max(1) + e[t]
        path = [best.argmax(1)]
        for step in reversed(back):
            path.append(step[np.arange(len(ids)), path[-1]])
        path = np.array(path[::-1])
        rows = np.flatnonzero((path > 0).any(0))
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in ids]
        if len(rows):
            alpha, beta, z = _forward_backward(e[:, rows], trans)
            sure = np.exp(np.take_along_axis(alpha + beta, path[:, rows][..., None], 2)[..., 0] - z)
            for r, row in enumerate(rows):
                t, tags = 0, path[:, row]
                while t < T:
                    if tags[t]:
                        kind, start = (tags[t] - 1) // 2, t
                        t += 1
                        while t < T and tags[t] == 2 * kind + 2:
                            t += 1
                        out[row].append((int(kind), start, t, float(sure[start:t, r].mean())))
                    else:
                        t += 1
        return out


def reconcile(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Of spans of a whole text, those without overlaps that have the greatest sum of posterior times length."""
    best: dict[tuple[int, int, int], float] = {}
    for k, a, b, s in found:
        best[k, a, b] = max(best.get((k, a, b), 0.0), s)
    spans = sorted(((k, a, b, s) for (k, a, b), s in best.items()), key=lambda x: (x[2], x[1], x[0]))
    ends = [s[2] for s in spans]
    total, take = [0.0], []
    for i, (_, a, b, s) in enumerate(spans):
        j = bisect.bisect_right(ends, a, 0, i)
        with_it = total[j] + s * (b - a)
        take.append(j if with_it > total[i] else -1)
        total.append(max(with_it, total[i]))
    out, i = [], len(spans)
    while i:
        if take[i - 1] >= 0:
            out.append(spans[i - 1])
            i = take[i - 1]
        else:
            i -= 1
    return out[::-1]


# --- training ----------------------------------------------------------------------------------------------------------


def made_examples(text_words: list[str], n: int, seed: int = 9) -> list[tuple[str, list[Span]]]:
    """Labelled texts made from a seed: words with personal data in many forms, and look-alikes without a label."""
    rng = np.random.default_rng(seed)
    pool = sorted({w for w in text_words if len(w) < 20}) or ["the", "of", "and"]
    word = lambda: str(pool[int(rng.integers(len(pool)))])
    digit = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    ascii_word = lambda: re.sub("[^a-z0-9]", "", word()) or "name"
    pick = lambda *x: x[int(rng.integers(len(x)))]

    def personal() -> tuple[str, str]:
        kind = pick(*KINDS)
        if kind == "email":
            return kind, f"{ascii_word()}{pick('', '.', '_', '-')}{pick(ascii_word(), digit(2), '')}@{ascii_word()}{pick('', '-', digit(1))}.{pick('example.com', 'com', 'org', 'co.uk', ascii_word() + '.net')}"
        if kind == "ip":
            return kind, ".".join(str(int(rng.integers(0, 256))) for _ in range(4))
        if kind == "card":
            return kind, pick(digit(16), digit(16), digit(15), pick(" ", "-").join(digit(4) for _ in range(4)), digit(4) + " " + digit(6) + " " + digit(5))
        return kind, pick(f"+{pick('1', digit(2))} ({digit(3)}) {digit(3)}-{digit(4)}", f"+{digit(2)} {digit(3)} {digit(4)} {digit(3)}", f"+{digit(11)}", f"({digit(3)}) {digit(3)}-{digit(4)}", f"+{digit(1)}-{digit(3)}-{digit(3)}-{digit(4)}")

    def ordinary() -> str:
        return pick(f"{digit(1)}.{digit(1)}", f"{digit(1)}.{digit(1)}.", f"{digit(4)}", f"{digit(3)},{digit(3)}", f"19{digit(2)}-0{digit(1)}-1{digit(1)}", f"{digit(2)}:{digit(2)}", f"v{digit(1)}.{digit(2)}.{digit(1)}",
                    f"{digit(2)}%", f"${digit(2)}.{digit(2)}", "".join(rng.choice(list("0123456789abcdef"), 40)), "".join(rng.choice(list("0123456789ABCDEF"), 40)), f"{word()}{digit(2)}", f"@{word()}", f"{word()} @ {word()}", f"({digit(1)})", f"no. {digit(6)}")

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(int(rng.integers(2, 5))):
            text += pick(" ", " ", "\n").join(word() for _ in range(int(rng.integers(1, 8)))) + pick(" ", ". ", ", ", " | ", ": ", ' "', "%%% ")
            if rng.random() < 0.5:
                kind, value = personal()
                spans.append((kind, len(text), len(text) + len(value)))
                text += value
            else:
                text += ordinary()
            text += pick(" ", ". ", ", ", "!! ", '" ', " ### ")
        out.append((text, spans))
    return out


def tag_windows(text: str, spans: list[Span]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Characters and tags of the windows of a labelled text."""
    c, tags = codes(text), np.zeros(len(text), dtype=np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        tags[a:b] = 2 * k + 2
        tags[a] = 2 * k + 1
    c, tags = np.concatenate([c, np.full(T, CHARS)]), np.concatenate([tags, np.zeros(T, dtype=np.int64)])
    return [(c[s : s + T], tags[s : s + T]) for s in window_starts(text)]


def train(examples: list[tuple[str, list[Span]]], windows: int = 6000, epochs: int = 6, seed: int = 1) -> Tagger:
    """Fit to at most ``windows`` windows of labelled texts."""
    rng = np.random.default_rng(seed)
    data = [w for text, spans in examples for w in tag_windows(text, spans)]
    data = [data[i] for i in rng.permutation(len(data))[:windows]]
    p: Params = {"chars": rng.normal(0, 0.3, (CHARS + 1, E)), "trans": np.zeros((TAGS, TAGS)), "out": rng.normal(0, 0.2, (2 * H, TAGS)), "bias": np.zeros(TAGS)}
    for side in (0, 1):
        p |= {f"w{side}": rng.normal(0, 0.3, (E, 4 * H)), f"u{side}": rng.normal(0, 0.2, (H, 4 * H)), f"b{side}": np.concatenate([np.zeros(H), np.ones(H), np.zeros(2 * H)])}
    for k in range(len(KINDS)):  # an inside follows only its own begin or inside
        p["trans"][[t for t in range(TAGS) if t not in (2 * k + 1, 2 * k + 2)], 2 * k + 2] = -8
    adam = Adam(p, 0.01)
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(data))
        for at in range(0, len(order), 48):
            some = [data[i] for i in order[at : at + 48]]
            adam.step(_gradients(p, np.stack([x for x, _ in some]), np.stack([y for _, y in some])))
    return Tagger({k: v.astype(np.float32) for k, v in p.items()})


def weak_labels(text: str) -> list[Span]:
    """Labels of a sampled text: fixed patterns, where any 13 to 19 digits count as a card."""
    spans = [s for s in base_spans(text) if s[0] != "card"]
    for m in _CARD.finditer(text):
        if 13 <= len(m[0].translate(_DIGITS)) <= 19 and not any(a < m.end() and m.start() < b for _, a, b in spans):
            spans.append(("card", *m.span()))
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not out or out[-1][2] <= s[1]:
            out.append(s)
    return out


def fit(docs: DataFrame, rows: int = 2000, chars: int = 20_000, made: int = 2500) -> Tagger:
    """Train from at most ``rows`` sampled texts with the labels of the patterns, and ``made`` labelled texts with the words of those."""
    some = sample_texts(docs, rows, chars)
    own = [(t, weak_labels(t)) for t in some]
    return train(own + made_examples([w for t in some[:300] for w in words(t)[:200]], made))


# --- scan ----------------------------------------------------------------------------------------------------------------


def find_all(some: list[str], model: Tagger) -> list[list[Span]]:
    """Spans of texts by kind, then start: those of the patterns, and those of the network that overlap none of them."""
    starts = [window_starts(t) for t in some]
    where = [(i, s) for i, own in enumerate(starts) for s in own]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in some]
    coded = {i: np.concatenate([codes(some[i]), np.full(T, CHARS)]) for i, own in enumerate(starts) if own}
    for at in range(0, len(where), BLOCK):
        part = where[at : at + BLOCK]
        for (i, s), spans in zip(part, model.decode(np.stack([coded[i][s : s + T] for i, s in part])), strict=True):
            n = len(some[i])
            for kind, a, b, sure in spans:
                cut = (a == 0 and s > 0) or (b == T and s + T < n and b - a < STEP)
                if not cut and s + b <= n:
                    found[i].append((kind, s + a, s + b, sure))
    out = []
    for text, own in zip(some, found, strict=True):
        spans = base_spans(text)
        for kind, a, b, sure in reconcile(own):
            if sure >= SURE and sum(ch.isdigit() or ch == "@" for ch in text[a:b]) >= (1 if kind == 0 else 4) and not any(x < b and a < y for _, x, y in spans):
                spans.append((KINDS[kind], a, b))
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
    return out


def base_only(some: list[str]) -> list[list[Span]]:
    return [base_spans(t) for t in some]


_LIST = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, model: Tagger) -> DataFrame:
    """(doc_id, spans, base) of each whole text: all spans and those of the patterns, code points with exclusive ends.

    One pass without a shuffle. A null or empty text has no spans. Repeated and null ids stay rows of their own, further
    columns are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size
    named = lambda found: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in found], _LIST)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        some = texts(batch)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), named(find_all(some, shared.value)), named(base_only(some))], names=["doc_id", "spans", "base"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return by_batch(docs.select("doc_id", "text"), run, f"doc_id long, spans {kind}, base {kind}")


def masked(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; null texts stay null, n_chars follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[str | None] = []
        for given, text, spans in zip(batch.column("text").to_pylist(), some := texts(batch), find_all(some, shared.value), strict=True):
            parts, end = [], 0
            for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                if a >= end:
                    parts += [text[end:a], f"<{kind}>"]
                    end = b
                elif b > end:  # overlapping kinds: nothing of the second stays either
                    end = b
            out.append(None if given is None else "".join(parts) + text[end:])
        columns = {n: batch.column(n) for n in batch.schema.names} | {"text": pa.array(out, pa.string())}
        if "n_chars" in columns:
            lengths = [old if t is None else len(t) for t, old in zip(out, columns["n_chars"].to_pylist(), strict=True)]
            columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return by_batch(docs, run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes))
