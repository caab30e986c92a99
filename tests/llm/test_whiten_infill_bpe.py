"""Whitening, fill-in-middle and byte-level encoding against plain versions, on given tables and on odd rows."""

import hashlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogflow.llm import bytebpe, infill, whitening
from catalogflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = "doc_id long, text string, n long, form string, ids int, output string, starts string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, marks in texts, further columns with names the operators use."""
    long = "é🙂 lorem  ipsum\n" * 30_000
    rows = [(1, "twice the same"), (1, "twice the same"), (1, "same id, another text"), (None, "no id"), (None, None), (None, None), (2, None), (3, ""),
            (4, long), (5, "has <M> in it"), (6, "x"), (7, " \n\t "), (-8, "below zero 🙂")]
    return spark.createDataFrame([(d, t, 1, "q", 2, "o", "s") for d, t in rows], ODD)


# --- whitening -------------------------------------------------------------------------------------------------------


def symmetric(kind: str) -> np.ndarray:
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    return {
        "random": np.cov(rng.normal(size=(300, 40)).T), "identity": np.eye(40), "ones": np.ones((40, 40)), "one": np.array([[2.0]]),
        "clusters": q @ np.diag([5.0] * 10 + [3.0] * 12 + [1.0] * 18) @ q.T, "graded": q @ np.diag(10.0 ** -np.arange(40)) @ q.T,
        "pairs": np.kron(np.eye(2), np.cov(rng.normal(size=(100, 20)).T)),
        "wilkinson": np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
    }[kind]


@pytest.mark.parametrize("kind", ["random", "identity", "ones", "one", "clusters", "graded", "pairs", "wilkinson"])
def test_eigenvectors(kind):
    a = symmetric(kind)
    k = min(32, len(a))
    values, columns = whitening.eigen(a, k)
    scale = np.linalg.eigvalsh(a)[-1]
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-13 * scale
    assert np.abs(columns.T @ columns - np.eye(k)).max() < 1e-12 and np.abs(a @ columns - columns * values).max() < 1e-12 * scale


def test_sturm_counts():
    rng = np.random.default_rng(4)
    d, e = rng.normal(size=12), rng.normal(size=11)
    own = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    shifts = np.linspace(-4, 4, 50)
    assert whitening.below(d, e, shifts).tolist() == [(own < s).sum() for s in shifts]


def test_whitening_of_all_vectors(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    got = QUERIES["op11_whiten"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    x = np.floor(64 * np.stack(vectors.embedding).astype(float)).astype(int) + 1_000_000
    n, sums = len(x), x.sum(0)
    z = x - sums / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    white = got.whitened.to_numpy().reshape(n, 32)
    want = (z @ u / np.sqrt(e))[np.argsort(vectors.vec_id)]
    assert np.abs(white * np.sign((white * want).sum(0)) - want).max() < 1e-8
    assert got.deviation[got.component == 1].tolist() == ((n * x - sums) ** 2).sum(1)[np.argsort(vectors.vec_id)].tolist()
    assert (got.n == n).all() and np.abs(got.explained.to_numpy().reshape(n, 32) / (e / np.trace(v)) - 1).max() < 1e-10
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    some = [(i, rng.normal(size=4).tolist(), 1, 2.0) for i in range(50)]
    out = [(90, None, 1, 2.0), (91, [1.0, None, 2.0, 3.0], 1, 2.0), (92, [1.0, float("nan"), 2.0, 3.0], 1, 2.0),
           (93, [1.0, float("inf"), 2.0, 3.0], 1, 2.0), (94, [1.0], 1, 2.0), (95, [], 1, 2.0), (96, [1e300, 0.0, 0.0, 0.0], 1, 2.0)]
    twice = [(1, some[1][1], 1, 2.0), (None, some[2][1], 1, 2.0)]
    vectors = spark.createDataFrame(some + twice + out, "vec_id long, embedding array<double>, deviation int, whitened double")
    model = whitening.fit(vectors, 32)
    got = whitening.whiten(vectors, model).toPandas()
    assert model.at.n == len(got) == 52 and model.identity_error < 1e-12 and len(model.variances) == 4
    assert sorted(got.vec_id.dropna().astype(int)) == sorted([*range(50), 1]) and got.vec_id.isna().sum() == 1
    assert whitening.fit(vectors.limit(0)) is None and whitening.fit(vectors.where("vec_id = 3")) is None  # no rows; no variance
    flat = spark.createDataFrame([(i, [float(i % 3), 7.0, float(i % 5), 2.0 * (i % 3)]) for i in range(30)], "vec_id long, embedding array<float>")
    assert len(whitening.fit(flat).variances) == 2  # a constant and a dependent dimension have no component


def test_deviations_are_exact_at_any_size():
    at = whitening.Centre(3, [2**51, -7, 5])
    x = np.array([[2**52, 1, 2], [-(2**51), 0, 3], [5, -8, 0]], dtype=np.int64)
    assert list(at.deviations(x)) == [sum((3 * int(c) - s) ** 2 for c, s in zip(row, at.sums, strict=True)) for row in x]
    small = np.array([[4, 5, 6]], dtype=np.int64)
    assert list(whitening.Centre(3, [9, 15, 20]).deviations(small)) == [(12 - 9) ** 2 + 0 + (18 - 20) ** 2]


# --- fill-in-middle --------------------------------------------------------------------------------------------------


def plain_infill(doc_id, text: str) -> tuple:
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", n, text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return ("spm", n, f"<S>{s}<P>{p}<M>{m}", a, b - a) if h4 % 100 < 20 else ("psm", n, f"<P>{p}<S>{s}<M>{m}", a, b - a)


def key(row) -> tuple:
    return tuple((x is None, x) for x in row)


def test_infill_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = []
    for r in docs:
        form, n, output, a, b = plain_infill(r["doc_id"], r["text"] or "")
        want.append((r["doc_id"], n, form, a, b, sha(output), sha(r["text"] or "")))
    got = [tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, SF).collect()]
    assert sorted(got, key=key) == sorted(want, key=key) and {r[2] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_infill_of_odd_rows(odd, size):
    if size == 1:
        odd = odd.where("doc_id <> 4 OR doc_id IS NULL")
    source = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    outputs = [tuple(r) for r in infill.transform(odd, size=size).collect()]
    want = [(d, n, f, o) for d, t in source for f, n, o, _, _ in [plain_infill(d, t)]]
    assert sorted(outputs, key=key) == sorted(want, key=key)
    restored = [(r["doc_id"], r["restored_sha256"]) for r in infill.digests(odd, size=size).collect()]
    assert sorted(restored, key=key) == sorted([(d, sha(t)) for d, t in source], key=key)
    assert infill.transform(odd.limit(0)).count() == 0 and infill.digests(odd.limit(0)).count() == 0


def test_infill_rates_and_seed(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text to cut").alias("text"))
    forms = infill.transform(docs, infill.Rule(plain=0, spm=100)).groupBy("form").count().collect()
    assert [(r["form"], r["count"]) for r in forms] == [("spm", 400)]
    one, other = (infill.transform(docs, infill.Rule(seed=s)).select("output").toPandas().output.tolist() for s in (1, 2))
    assert sorted(one) != sorted(other)


def test_restoring_moves_nothing_and_equal_rows_spread(spark):
    docs = spark.createDataFrame([(None, "")] * 500 + [(i, "t") for i in range(100)], "doc_id long, text string")
    emit = docs.rdd.mapPartitionsWithIndex(lambda split, rows: infill.emitted(rows, infill.Rule(), split, 10))
    pieces = emit.repartitionAndSortWithinPartitions(4, infill.by_document)
    held = pieces.mapPartitions(lambda part: [sum(k[-1] == 0 for k, _ in part)]).collect()
    assert sum(held) == 600 and max(held) < 250
    again = infill.restored(pieces)
    assert again.partitioner == pieces.partitioner and again.toDebugString().count(b"ShuffledRDD") == 1


def test_documents_may_be_left_unread():
    stream = [((1, 0), "a"), ((1, 1), ("x",)), ((1, 2), ("y",)), ((2, 0), "b"), ((3, 0), "c"), ((3, 1), ("z",))]
    assert [(k, h) for k, h, _ in infill.documents(stream)] == [((1,), "a"), ((2,), "b"), ((3,), "c")]
    assert [list(p) for _, _, p in infill.documents(stream)] == [["x", "y"], [], ["z"]]


# --- byte-level encoding ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.ranks_of(RANKS), special_tokens={})


def test_byte_characters():
    table = bytebpe.byte_characters()
    assert len(set(table)) == 256 and table[32] == "Ġ" and table[10] == "Ċ" and table[65] == "A" and not any(c.isspace() for c in table)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdetrvml01éab,.-　 \x1c\r‍🙂漢"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_are_those_of_the_ranks(plain, text):
    codec = bytebpe.codec_of(RANKS, True)
    ids, starts, ends = next(codec.encode([text]))
    assert ids.tolist() == plain.encode_ordinary(text) and codec.text(ids) == text
    for i, (s, e) in enumerate(zip(starts, ends, strict=True)):  # a token's bytes lie in the characters it covers
        assert codec.bytes_of[ids[i]] in text[s:e].encode() and s < e
    assert (np.diff(starts) >= 0).all() and (not len(ends) or ends[-1] == len(text))


def test_encoding_of_all_documents(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = []
    for r in docs:
        ids = plain.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha(r["text"] or "")))
    assert sorted(map(tuple, QUERIES["op13_byte_bpe"](spark, SF).collect())) == sorted(want)


def test_encoding_of_odd_rows(odd, plain):
    source = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    encoded = bytebpe.encode(odd, RANKS)
    assert sorted([(r["doc_id"], tuple(r["ids"])) for r in encoded.collect()], key=key) == sorted([(d, tuple(plain.encode_ordinary(t))) for d, t in source], key=key)
    assert sorted([tuple(r) for r in bytebpe.decode(encoded, RANKS).collect()], key=key) == sorted(source, key=key)
    assert bytebpe.encode(odd, RANKS, offsets=False).columns == ["doc_id", "ids"]
    assert bytebpe.encode(odd.limit(0), RANKS).count() == 0 and bytebpe.digests(odd.limit(0), RANKS).count() == 0


def test_decoding_of_split_characters(spark, plain):
    ids = plain.encode_ordinary("🙂" * 3)
    block, bytebpe.BLOCK = bytebpe.BLOCK, 1
    try:
        assert bytebpe.codec_of(RANKS).text(np.array(ids)) == "🙂" * 3  # a character's bytes come from several blocks
    finally:
        bytebpe.BLOCK = block
    half = next(i for i in ids if len(plain.decode_single_token_bytes(i)) < 4)
    rows = spark.createDataFrame([(1, [half]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert dict(map(tuple, bytebpe.decode(rows, RANKS).collect())) == {1: "�", 2: None, 3: ""}


def test_store_is_cleared(plain, monkeypatch):
    codec = bytebpe.Codec(RANKS)
    monkeypatch.setattr(bytebpe, "CACHE", 10)
    for text in ("one two three four", "five six seven eight nine", "one two"):
        assert next(codec.encode([text]))[0].tolist() == plain.encode_ordinary(text)
