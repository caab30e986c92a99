"""Byte-level byte-pair encoding by a file of ranks, with the tokenizers library over Arrow batches, and decoding.

The ranks give the vocabulary: each token's bytes, written with the character that stands for each byte. A token is merged from any two
tokens that make it up, in the order of its rank. Texts are cut where white space follows something else, which no match of
the splitting pattern crosses, so that a part's ids do not depend on what is around it; parts met before are looked up. Offsets
count code points of the text; a token that holds some bytes of a character covers that character. Decoding turns the
characters of each token back into bytes, and joins bytes before it reads characters, since a character may be split between tokens.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalogflow.llm.common import by_batch, texts

# Fixed value: the pattern that splits texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CUT = re.compile(r"(?<=\S)(?= )")
CACHE = 4_000_000  # characters of parts kept from batch to batch
BLOCK = 1 << 16  # ids decoded at once

IDS_SCHEMA = "doc_id long, ids array<int>"
OFFSETS_SCHEMA = "doc_id long, ids array<int>, starts array<int>, ends array<int>"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable and no space, otherwise the next free one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and ranks from a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def tokenizer_from(ranks: dict[bytes, int]):
    """A tokenizer that merges as the ranks say: a whole match that is a token stays one."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_characters()
    named = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (named[token[:i]], named[token[i:]])
        for token in sorted(ranks, key=ranks.__getitem__) for i in range(len(token) - 1, 0, -1) if token[:i] in ranks and token[i:] in ranks
    ]
    out = Tokenizer(models.BPE(vocab={named[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(PATTERN), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


def pieces(text: str) -> list[str]:
    """The text in parts that are encoded apart."""
    return CUT.split(text) if text else []


class Codec:
    """Encoding with a store of parts met before, and decoding."""

    def __init__(self, path: str, offsets: bool = False) -> None:
        self.tokenizer, self.offsets = tokenizer_from(ranks_of(path)), offsets
        back = {c: b for b, c in enumerate(byte_characters())}
        size = self.tokenizer.get_vocab_size()
        self.bytes_of = [bytes(back[c] for c in self.tokenizer.id_to_token(i)) for i in range(size)]
        self.clear()

    def clear(self) -> None:
        """Forget all parts."""
        self.index: dict[str, int] = {}
        self.held = 0
        self.tokens = np.zeros((3 if self.offsets else 1, 0), dtype=np.int32)  # of all parts: ids, and starts and ends in the part
        self.first, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _learn(self, parts: list[str]) -> None:
        batch = self.tokenizer.encode_batch if self.offsets else self.tokenizer.encode_batch_fast
        ids: list[int] = []
        spans: list[tuple[int, int]] = []
        count: list[int] = []
        for at in range(0, len(parts), 1000):
            for e in batch(parts[at : at + 1000], add_special_tokens=False):
                own = e.ids
                ids += own
                count.append(len(own))
                if self.offsets:
                    spans += e.offsets
        rows = [np.array(ids, dtype=np.int32)[None]]
        if self.offsets:
            rows.append(np.array(spans, dtype=np.int32).reshape(-1, 2).T)
        self.first = np.concatenate([self.first, self.tokens.shape[1] + np.cumsum([0, *count])[:-1]])
        self.count = np.concatenate([self.count, np.array(count, dtype=np.int64)])
        self.tokens = np.concatenate([self.tokens, np.concatenate(rows)], axis=1)
        self.index.update(zip(parts, range(len(self.index), len(self.index) + len(parts)), strict=True))
        self.held += sum(map(len, parts))

    def encode(self, some: list[str]) -> Iterator[np.ndarray]:
        """For each text a row of ids, and with offsets the code points at which each token starts and ends as two more rows."""
        if self.held > CACHE:
            self.clear()
        split = [pieces(t) for t in some]
        if new := list({p for parts in split for p in parts if p not in self.index}):
            self._learn(new)
        for parts in split:
            at = np.array(list(map(self.index.__getitem__, parts)), dtype=np.int64)
            count = self.count[at]
            ends = np.cumsum(count)
            total = int(ends[-1]) if len(ends) else 0
            # place in the store: where the part begins there, plus the distance from where it begins in the text
            out = self.tokens[:, np.repeat(self.first[at] - (ends - count), count) + np.arange(total)]
            if self.offsets:
                out[1:] += np.repeat(np.cumsum([0, *map(len, parts)])[:-1], count).astype(np.int32)
            yield out

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes behind ids, block by block."""
        for at in range(0, len(ids), BLOCK):
            yield b"".join(map(self.bytes_of.__getitem__, ids[at : at + BLOCK].tolist()))

    def text(self, ids: np.ndarray) -> str:
        """The text behind ids; a character split between tokens or blocks is whole again, bytes that are no character become U+FFFD."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        return "".join([reader.decode(b) for b in self.decoded(ids)]) + reader.decode(b"", True)


@functools.lru_cache(maxsize=2)
def codec_of(path: str, offsets: bool = False) -> Codec:
    """One codec with and one without offsets for all tasks of a Python worker."""
    return Codec(path, offsets)


def encode(docs: DataFrame, ranks: str, offsets: bool = True) -> DataFrame:
    """(doc_id, ids[, starts, ends]) of every whole text, in one pass without a shuffle.

    Null and empty texts have no ids. Rows with equal or null ids are texts of their own, further columns are ignored, an empty
    table gives no rows. ``ranks`` is the path of the rank file on every machine.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(codec_of(ranks, offsets).encode(texts(batch)))
        columns = [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in range(3 if offsets else 1)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=["doc_id", "ids", "starts", "ends"][: 1 + len(columns)])

    return by_batch(docs.select("doc_id", "text"), run, OFFSETS_SCHEMA if offsets else IDS_SCHEMA)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): null ids give a null text, ids outside the vocabulary are an error."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_of(ranks)
        rows = [None if ids is None else codec.text(np.array(ids, dtype=np.int64)) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, pa.string())], names=["doc_id", "text"])

    return by_batch(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text: its ids (little-endian, 32 bits) and the bytes decoded from them.

    Rows are treated as by ``encode``, and in one pass, so that ids never leave the worker.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_of(ranks)
        rows = []
        for (ids,) in codec.encode(texts(batch)):
            plain = hashlib.sha256()
            for block in codec.decoded(ids):
                plain.update(block)
            rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), plain.hexdigest()))
        n, own, back = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return by_batch(docs.select("doc_id", "text"), run, DIGEST_SCHEMA)
