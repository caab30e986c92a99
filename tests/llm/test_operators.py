"""Dealt operators against brute force, on small tables and on tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import re
from collections import Counter, defaultdict
from dataclasses import replace
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogflow.llm import digests, licenses, mixing, nearest, neardup, packing, personal, quality, secrets, toxicity
from catalogflow.llm.queries import word_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind string, n long"
NOTICE = licenses.TEMPLATES["apache-2"]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, ties, repeated rows, further columns whose names clash."""
    long = "lorem ipsum dolor sit amet consectetur " * 20_000
    rows = [
        (1, "one two three four five six seven mail a.b@c.de", "en", "a", 47, "x", 1), (1, "one two three four five six seven mail a.b@c.de", "en", "a", 47, "x", 1),
        (2, None, None, None, None, None, None), (3, "", "en", "a", 0, "x", 2), (None, f"no id {NOTICE}", "en", None, 5, "y", 3),
        (4, long, "en", "b", len(long), "z", 4), (5, "one two three four five six seven mail a.b@c.de", "en", "b", 47, "x", 1),
        (6, "   \n\t ", "en", "b", 6, None, 0), (7, "\U0001f600 é ß İ token = \"abcDEF123456\"", "xx", "c", 1, "q", 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- 1 mixing --------------------------------------------------------------------------------------------------------


def edf(b: list[int]) -> list[tuple[int, int]]:
    """Earliest due block first, slot by slot: (source, block)."""
    m, done, out = sum(b), [0] * len(b), []
    for t in range(m):
        ready = [(ceil(Fraction((done[i] + 1) * m, x)), i) for i, x in enumerate(b) if done[i] < x and floor(Fraction(done[i] * m, x)) <= t]
        i = min(ready)[1]
        out.append((i, done[i]))
        done[i] += 1
    return out


def test_mixing_is_the_plain_schedule(spark):
    n = {"a": 333, "b": 101, "c": 40, "d": 7}
    docs = spark.createDataFrame([(k, s) for k, s in enumerate(s for s, c in n.items() for _ in range(c))], "doc_id long, source string")
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.15), ("d", 0.05)], "source string, weight double")
    got = mixing.mix(docs, weights, block_rows=4, cycle=20, bucket_rows=16).toPandas()
    assert len(got) == sum(n.values()) and got.doc_id.is_unique
    share, blocks = [10, 6, 3, 1], [ceil(c / 4) for c in n.values()]
    slots, cycle = [], 0
    while any(b - cycle * a > 0 for a, b in zip(share, blocks, strict=True)):
        own = [max(0, min(a, b - cycle * a)) for a, b in zip(share, blocks, strict=True)]
        live = [i for i, x in enumerate(own) if x]
        slots += [("abcd"[live[i]], cycle * share[live[i]] + j) for i, j in edf([own[i] for i in live])]
        cycle += 1
    mine = got.groupby("slot")[["source", "block"]].first()
    assert [tuple(x) for x in mine.loc[range(len(slots))].to_numpy()] == slots and len(mine) == len(slots)
    sizes = got.groupby(["source", "block"]).size()
    assert all(sizes[s, b] == min(4, n[s] - 4 * b) for s, b in sizes.index)
    assert got.groupby(["source", "block"]).place.apply(lambda x: sorted(x) == list(range(len(x)))).all()


def test_mixing_stays_within_one_block(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    got = mixing.mix(docs, block_rows=5, cycle=100, bucket_rows=64)
    assert got.count() == 6000
    slots = got.groupBy("slot").agg(F.first("source").alias("source"), F.countDistinct("source", "block").alias("one")).toPandas().sort_values("slot")
    assert (slots.one == 1).all() and list(slots.slot) == list(range(len(slots)))
    count = docs.groupBy("source").count().toPandas().set_index("source")["count"]
    w = count**0.7 / (count**0.7).sum() * 100
    share = w.round().clip(lower=1).astype(int)
    m = share.sum()
    first = slots.source[: m * int(min(ceil(c / 5) // share[s] for s, c in count.items()))].to_numpy()
    for s in count.index:
        lag = np.abs(np.cumsum(first == s) - np.arange(1, len(first) + 1) * share[s] / m)
        assert lag.max() < 1


def test_mixing_schedules_ten_thousand_sources(spark):
    docs = spark.range(45_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.least(F.col("id") % 10_000, F.col("id") % 12_500)).alias("source"))
    got = mixing.mix(docs, block_rows=1).select("source", "block", "slot").toPandas()
    assert sorted(got.slot) == list(range(45_000)) and not got.duplicated(["source", "block"]).any()
    n = got.groupby("source").size()
    assert len(n) > 9_000
    weight = n**0.7
    own = np.minimum((weight * 1000 / weight.sum()).round().clip(lower=1).astype(int), n)  # blocks in the first cycle
    m = int(own.sum())
    first = got[got.slot < m]
    assert (first.groupby("source").size() == own).all()
    b = first.source.map(own)
    assert ((first.block * m // b <= first.slot) & (first.slot < -(-(first.block + 1) * m // b))).all()  # released and not yet due


def test_mixing_without_positive_weights(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, source string")
    none = spark.createDataFrame([("a", 0.0), ("b", None)], "source string, weight double")
    assert sorted(r.slot for r in mixing.mix(docs, none, block_rows=1).collect()) == [0, 1, 2]


def test_mixing_keeps_odd_rows(odd, spark):
    got = mixing.mix(odd)
    assert got.columns == [*odd.columns, "block", "slot", "place"]
    assert Counter(rows(got.drop("block", "slot", "place"))) == Counter(rows(odd))
    assert mixing.mix(odd.limit(0)).count() == 0


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["share", "parts", "turn", "part", "s", "n", "k", "d", "h", "b", "_n", "_k", "_s", "o.x"]
    docs = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source"), *[F.lit(i).alias(n) for i, n in enumerate(names)], F.lit(9).alias("slot"))
    got = mixing.mix(docs, block_rows=4, cycle=10)
    assert got.columns == ["doc_id", "source", *names, "block", "slot", "place"] and got.select("slot", "place").distinct().count() == 50
    assert {tuple(r[2:-3]) for r in got.collect()} == {tuple(range(len(names)))}


def test_mixing_spreads_null_ids(spark):
    docs = spark.range(0, 40_000, 1, 4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one").alias("source"), F.col("id").alias("n_chars"))
    buckets = mixing.numbered_by_source(docs, ["doc_id"], 1024).select(F.floor(F.col("k") / 1024).alias("b"), "k")
    assert sorted(r.k for r in buckets.collect()) == list(range(40_000))
    plan = mixing.numbered_by_source(docs, ["doc_id"], 1024).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in plan) < 40_000


def test_mixing_plans_its_steps_apart(spark):
    """The driver keeps a plan and its text for every stage: the plan that carries the rows has not the schedule's windows in it."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 5).cast("string").alias("source"))
    mixed = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bWindow \[", mixed)) <= 2 and len(re.findall(r"\bExchange ", mixed)) <= 6


def test_mixing_shuffles_whole_rows_once(spark, capsys):
    """Of all shuffles in the plan only the one by source and bucket carries the rows themselves."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 5).cast("string").alias("source"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    mixing.mix(docs).explain("formatted")
    inputs = re.findall(r"Exchange[^\n]*\nInput[^\n]*", capsys.readouterr().out)
    assert sum(bool(re.search(r"\bd#|\btext#", x)) for x in inputs) == 1


# --- 2 packing -------------------------------------------------------------------------------------------------------


def test_packing_holds_every_token_once(spark, odd):
    from tokenizers import Tokenizer

    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = texts.unionByName(odd.where("doc_id = 7 OR doc_id = 3 OR doc_id = 4").select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    pieces = packing.pack(docs, word_tokenizer(), lower_words=True).toPandas()
    plain = Tokenizer.from_file(word_tokenizer())
    source = {r.doc_id: r.text for r in docs.collect()}
    ids = {d: plain.encode(t or "", add_special_tokens=False).ids + [2] for d, t in source.items()}
    got = defaultdict(list)
    for p in pieces.sort_values(["doc_id", "start"]).itertuples():
        assert p.start == len(got[p.doc_id]) and p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        got[p.doc_id] += np.frombuffer(p.ids, dtype="<u4").tolist()
    assert dict(got) == ids
    padding = 0
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        used = s.length.sum()
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and used <= 4096
        padding += 0 if used & (used - 1) == 0 else 4096 - used
    assert padding < 0.01 * pieces.length.sum() + 4096 * 8  # one padded end for each task
    group = pieces.groupby("step_group").length.sum()
    assert group.max() <= 1.5 * (1 << 16)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_pack_pool_round_trip(lengths):
    windows = packing.pack_pool(lengths, (512, 1024, 2048, 4096), 64)
    seen = Counter()
    for context, pieces in windows:
        used = sum(p[2] for p in pieces)
        assert used <= context
        for doc, start, n in pieces:
            seen.update((doc, k) for k in range(start, start + n))
    assert seen == Counter((d, k) for d, n in enumerate(lengths) for k in range(n))
    assert sum(1 for c, p in windows if sum(x[2] for x in p) != c) <= 1


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abzAZéÀßẞİıKſσΣ019 .,'!?-<|>\n\t ’日_½²") | st.characters(exclude_categories=("Cs",)), max_size=60))
def test_chunk_ids_are_the_tokenizers(text):
    encoder = packing.tokenizer_of(word_tokenizer(), True)
    assert next(iter(encoder.encode([text]))).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# --- 3, 4 secrets and personal data ------------------------------------------------------------------------------------

PIECES = st.lists(st.sampled_from(["password", "Token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc123XYZ/+", "deadbeef0123", "AKIA", "ABCD1234EFGH56", "@", ".", "a", "mail", "-", "1", "23", "256",
                                   "4111111111111111", "+1 (017) 555-7713", "+", "(", ")", "10.0.0.1", "é", "\n", "x_y", "%"]), max_size=25).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_base_secrets_are_the_patterns(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    want = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
    want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    assert secrets.base_spans(text) == want


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_base_personal_data_is_the_patterns(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    want += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and personal.luhn(digits(m[0]))]
    want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    assert personal.base_spans(text) == want


def test_markov_models_tell_keys_from_names(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    half = lambda k: [w for t in texts[k::2] for w in re.findall(r"\w+", t.lower())]
    random, ordinary = secrets.labelled_strings(half(0), 1500, seed=1)
    model = secrets.train(random, ordinary)
    new_random, new_ordinary = secrets.labelled_strings(half(1), 300, seed=2)
    assert np.mean([model.score(s) > model.needed for s in new_random]) > 0.8
    assert np.mean([model.score(s) > model.needed for s in new_ordinary]) < 0.03
    text = "é key Zk3vX9qLw72RtYbN4mPc8sHd and some_ordinary_variable_name here"
    assert [(k, text[a:b]) for k, a, b in secrets.find(text, model)] == [("random", "Zk3vX9qLw72RtYbN4mPc8sHd")]


def test_secret_columns(odd, spark):
    got = secrets.digest_columns(secrets.scan(odd, secrets.fit(odd)), secrets.KINDS[:3])
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert got.count() == odd.count() and by[2].spans == by[3].spans == ""
    assert by[7].spans == "assign:8:29" and by[7].n_assign == 1 and by[7].base_sha256 == hashlib.sha256(b"assign:8:29").hexdigest()
    assert secrets.scan(odd.limit(0), secrets.fit(odd.limit(0))).count() == 0


@pytest.fixture(scope="module")
def tagger():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda sigma".split()
    return personal.train(personal.made_examples(words, 900, seed=4), epochs=5)


def test_tagger_on_held_out_texts(tagger):
    made = personal.made_examples("other words for the test that were never seen".split(), 120, seed=8)
    found = personal.find_all([t for t, _ in made], tagger)
    want = sum(len(s) for _, s in made)
    hit = sum(any(x[1] < b and a < x[2] for x in f) for (_, s), f in zip(made, found, strict=True) for _, a, b in s)
    extra = sum(not any(x[1] < b and a < x[2] for _, a, b in s) for (_, s), f in zip(made, found, strict=True) for x in f)
    assert hit > 0.9 * want and extra < 0.1 * want


def test_tagger_gradients_and_paths(tagger):
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + rng.normal(0, 0.05, v.shape) for k, v in tagger.params.items()}
    ids, tags = rng.integers(0, personal.CHARS, (2, personal.T)), rng.integers(0, personal.TAGS, (2, personal.T))

    def loss():
        e = personal.emissions(p, ids)
        _, _, z = personal._forward_backward(e, p["trans"])
        path = sum(e[t, np.arange(2), tags[:, t]] for t in range(personal.T)) + sum(p["trans"][tags[:, t - 1], tags[:, t]] for t in range(1, personal.T))
        return float((z - path).mean())

    g = personal._gradients(p, ids, tags)
    for name in ("trans", "out", "u0", "w1", "b0", "chars"):
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = p[name][i]
        p[name][i] = old + 1e-5
        up = loss()
        p[name][i] = old - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[name][i], rel=1e-3, abs=1e-6)
        p[name][i] = old


def test_windows_and_reconciliation(tagger):
    text = "x" * 100 + "1" + "y" * 200
    starts = personal.window_starts(text)
    assert starts == [64, 96] and all(s <= 100 < s + personal.T for s in starts)
    assert personal.window_starts("no digit here") == [] and personal.window_starts("7") == [0]
    assert personal.reconcile([(0, 0, 10, 0.9), (1, 5, 12, 0.99), (0, 10, 20, 0.9), (0, 0, 10, 0.95)]) == [(0, 0, 10, 0.95), (0, 10, 20, 0.9)]
    assert personal.find_all(["", "a" * 5000 + " call +1 (017) 555-7713 now"], tagger)[1] == [("phone", 5006, 5023)]


def test_masked_keeps_columns(odd, tagger):
    got = personal.masked(odd, tagger)
    assert got.columns == odd.columns and got.count() == odd.count()
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert by[2].text is None and by[5].text == "one two three four five six seven mail <email>" and by[5].n_chars == len(by[5].text)
    columns = secrets.digest_columns(personal.scan(odd, tagger), personal.KINDS, "base")
    assert {r.doc_id: r.n_email for r in columns.collect() if r.doc_id is not None}[5] == 1
    assert personal.masked(odd.limit(0), tagger).count() == 0


# --- 5, 9 classifiers --------------------------------------------------------------------------------------------------


def made_texts(n, seed, bad):
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list("aeioulnrst"), int(rng.integers(2, 8)))) for _ in range(300)]
    texts, y = [], rng.random(n) < 0.4
    for label in y:
        w = [pool[int(i)] for i in rng.integers(0, 300, int(rng.integers(5, 150)))]
        if label:
            w.insert(int(rng.integers(len(w))), bad[int(rng.integers(len(bad)))])
        texts.append(" ".join(w))
    return texts, y.astype(np.float32)


def test_toxicity_on_held_out_texts():
    bad = ["vilefool", "badword", "scumly"]
    model = toxicity.train(*made_texts(500, 1, bad), epochs=6)
    texts, y = made_texts(200, 2, bad)
    assert ((toxicity.Scorer(model)(texts) >= 0.5) == y).mean() > 0.93
    scorer = toxicity.Scorer(model)
    assert np.allclose(scorer(texts[:50]), np.concatenate([scorer(texts[:20]), scorer(texts[20:50])]), atol=1e-5)
    assert 0 <= scorer([""])[0] <= 1 and scorer(["word " * 100_000 + "badword"]).shape == (1,)


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    model = toxicity.train(*made_texts(60, 3, ["vile"]), epochs=1)
    p = {k: v.astype(np.float64) for k, v in model.params.items()}
    w = rng.integers(0, len(p["words"]), (3, toxicity.T))
    w[2, 20:] = -1
    ids, n, y = rng.integers(0, toxicity.PIECES, (3, toxicity.T, 4)), np.full((3, toxicity.T), 4.0), np.array([1.0, 0, 1])

    def loss():
        x = np.concatenate([p["words"][w], p["chars"][ids].sum(2) / 4], axis=2).reshape(-1, 2 * toxicity.E)
        projected = np.hstack([x @ p["w0_in"] + p["b0"], x @ p["w1_in"] + p["b1_in"]])
        empty = np.hstack([p["b0"], p["b1_in"]])[None]
        number = np.where(w < 0, len(x), np.arange(len(x)).reshape(w.shape))
        logits = np.array(toxicity.window_logits(np.vstack([projected, empty]), number, p), dtype=np.float64)
        return float(np.mean(np.logaddexp(0, logits) - y * logits))

    g = toxicity._loss_gradients(p, w, ids, n, y, np.ones(3))
    for name in ("u0", "w1_in", "wa", "va", "w1", "b0"):
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = p[name][i]
        p[name][i] = old + 1e-2
        up = loss()
        p[name][i] = old - 1e-2
        assert (up - loss()) / 2e-2 == pytest.approx(g[name][i], rel=0.05, abs=1e-4)
        p[name][i] = old


def test_classifiers_on_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 1), (4, 1, 0), (7, 1, 1), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for given_labels in (labels, labels.limit(0)):
        toxic = toxicity.score(odd, toxicity.fit(odd, given_labels)).collect()
        fine = quality.held(quality.score(odd, quality.fit(odd, given_labels))).collect()
        for got in (toxic, fine):
            assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(odd.limit(0), toxicity.fit(odd, labels)).count() == 0
    kept = quality.score(odd, quality.fit(odd, labels), keep=True)
    assert kept.columns == [*odd.columns, "quality_score"] and kept.count() == odd.count()


def test_held_out_labels_are_never_learned(spark):
    from catalogflow.llm.common import learning_texts

    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    import zlib

    some, y = learning_texts(docs, labels, "toxic", 5, 0, 1000, 100)
    want = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    assert some == [f"t{i}" for i in want] and list(y) == [i % 2 for i in want]
    assert len(learning_texts(docs, labels, "toxic", 5, 0, 20, 100)[0]) == 20


def test_quality_learns_from_features_made_in_tasks(spark):
    """As many columns as the driver needs, in the order of ids and texts, also where ids repeat."""
    from catalogflow.llm.common import learning_rows, learning_texts

    docs = spark.createDataFrame([(i % 50, f"{'é' * (i % 7)} w{i} word {i * 37 % 11} two") for i in range(120)] + [(3, ""), (4, None), (None, "x")], "doc_id long, text string")
    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    vectors = quality.word_vectors(docs)
    some, want = learning_texts(docs, labels, "quality", 4, 2, 1000, 100)
    x, y = quality.learning_features(learning_rows(docs, labels, "quality", 4, 2, 1000, 100), vectors)
    assert len(some) > 60 and (x == quality.pooled(some, vectors, quality.Buckets())).all() and list(y) == list(want)
    x, y = quality.learning_features(learning_rows(docs, labels.limit(0), "quality", 4, 2, 1000, 100), vectors)
    assert x.shape == (0, 2 * quality.DIM + 3) and not len(y)


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifier_on_given_labels(spark, kind):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    if kind == "quality":
        got = quality.held(quality.score(docs, quality.fit(docs, labels)))
    else:
        got = toxicity.score(docs, toxicity.fit(docs, labels))
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held[kind]).mean() > 0.87


def test_context_vectors_are_sums_over_all_texts(spark):
    docs = spark.createDataFrame([("a b c a",), ("b a",), (None,)], "text string")
    got = quality.word_vectors(docs.repartition(3))
    place, sign = quality.index_vectors()
    b = quality.Buckets()
    want = np.zeros((quality.ROWS, quality.DIM))
    for text in ("a b c a", "b a"):
        code = b.of(text)
        for seq in (code // quality.SHAPES, quality.WORDS + code % quality.SHAPES):
            for i, x in enumerate(seq):
                for j in range(max(0, i - 2), min(len(seq), i + 3)):
                    if j != i:
                        for k in (0, 1):
                            want[x, place[seq[j], k]] += sign[seq[j], k]
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(got, want / np.maximum(norm, 1e-9), atol=1e-6)


# --- 6 near duplicates -------------------------------------------------------------------------------------------------


def plain_classes(texts: dict) -> dict:
    """All pairs of distinct shingle sets of similarity 0.8 or more, and the smallest id of each component."""
    s = {}
    for d, t in texts.items():
        w = re.findall(r"\w+", (t or "").lower())
        s[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()
    parent = {d: d for d in s}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(s[a] & s[b])
            if s[a] == s[b] or both and both / (len(s[a]) + len(s[b]) - both) >= 0.8:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


def copies(spark, n=260, seed=3):
    """A hot group of edited copies with chains, exact copies, shared passages and unlike texts."""
    rng = np.random.default_rng(seed)
    pool = [f"w{i}" for i in range(400)]
    word = lambda k: [pool[int(i)] for i in rng.integers(0, 400, k)]
    base, passage, out = word(120), word(30), []
    for i in range(n):
        if i % 3 == 0:
            w = list(base)
            for _ in range(int(rng.integers(0, 8))):
                w[int(rng.integers(len(w)))] = pool[int(rng.integers(400))]
        elif i % 3 == 1:
            w = word(40) + passage + word(10)
        else:
            w = word(int(rng.integers(1, 60)))
        out.append((i, " ".join(w)))
    out += [(n + k, out[k][1]) for k in range(0, 60, 2)] + [(n + 100, None), (n + 101, ""), (n + 102, "Some, few words."), (n + 103, "some few WORDS")]
    return spark.createDataFrame(out, "doc_id long, text string")


def test_near_duplicates_are_all_pairs_classes(spark):
    for docs in (copies(spark), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        got = {r.doc_id: r.class_id for r in neardup.groups(docs).collect()}
        assert got == plain_classes({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})


def test_repeated_lines_lose_no_links(spark):
    """Texts that differ in how often they repeat a line: alike as sets, unlike as multisets."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        lines = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 20)) for _ in range(40)]
        rows += [(3 * k, "\n".join(lines)), (3 * k + 1, "\n".join(lines[:20] + [lines[20]] * (20, 50, 200)[k % 3] + lines[21:])),
                 (3 * k + 2, "\n".join([*lines[:39], lines[3]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_classes(dict(rows))
    assert {r.doc_id: r.class_id for r in neardup.groups(docs).collect()} == want and len(set(want.values())) == 60


def test_repeated_ids_do_not_depend_on_row_order(spark):
    a, b = ("one two three four five six seven eight nine ten " + x for x in ("eleven", "twelve"))
    rows = [(1, a), (1, "an unlike text of the same id with words of its own"), (2, a), (3, b + " thirteen fourteen fifteen")]
    got = [{r.doc_id: r.class_id for r in neardup.groups(spark.createDataFrame(x, "doc_id long, text string").coalesce(1)).collect()} for x in (rows, rows[::-1])]
    assert got[0] == got[1] and len(got[0]) == 3


def test_rare_pairs_hold_every_similar_pair(spark):
    rng = np.random.default_rng(4)
    sets = []
    for k in range(120):
        own = set(map(int, rng.integers(0, 40 if k % 2 else 2000, int(rng.integers(1, 30)))))
        sets.append((k, own | set(range(10_000, 10_000 + int(rng.integers(0, 60))))))
    rows = spark.createDataFrame([(k, len(s), k, sorted(s)) for k, s in sets], "doc_id long, n int, c long, s array<long>")
    got = {(r.a, r.b) for r in neardup.rare_pairs(rows, 0.8).collect()}
    alike = {(i, j) for i, s in sets for j, t in sets if i < j and len(s & t) >= 0.8 * len(s | t)}
    assert alike and alike <= got and len(got) < 120 * 119 / 2


def test_kept_has_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 1, "x"), (1, "a b c d e f", 1, "y"), (2, "a b c d e f", 1, "x"), (None, "z", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, `r.k` string")
    got = neardup.kept(docs)
    assert got.columns == docs.columns and sorted(r.doc_id or 0 for r in got.collect()) == [0, 1]


def test_kept_evaluates_the_classes_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 15} of some words here") for i in range(20)], "doc_id long, text string")
    seen, plain = spark.sparkContext.accumulator(0), neardup.groups

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(neardup, "groups", lambda *a: plain(*a).mapInArrow(count, "doc_id long, class_id long, links long"))
    assert sorted(r.doc_id for r in neardup.kept(docs).collect()) == list(range(15)) and seen.value == 20


def test_near_duplicates_on_odd_rows(odd):
    got = {r.doc_id: r.class_id for r in neardup.groups(odd).collect()}
    assert got == {1: 1, 5: 1, 2: 2, 3: 2, 6: 2, 4: 4, 7: 7}
    kept = neardup.kept(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4, 7]
    assert neardup.groups(odd.limit(0)).count() == neardup.kept(odd.limit(0)).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    h.sort()
    w = rng.integers(1, 5, 300)
    agree, trials = [], 12
    for k in range(trials):
        a, b = h[:240] + np.uint64(k * 1000), h[60:] + np.uint64(k * 1000)
        s = neardup.signatures([(a, w[:240]), (b, w[60:])])
        agree.append((s[0] == s[1]).mean())
    x, y = {i: w[i] for i in range(240)}, {i: w[i] for i in range(60, 300)}
    want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in range(300)) for i in range(60, 240))
    assert np.mean(agree) == pytest.approx(want, abs=0.05)


def test_classes_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(205, 203), (204, 205), (203, 202)]
    got = {r.doc_id: r["class"] for r in neardup.classes(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys(range(202, 206), 202)}


# --- 7 licenses --------------------------------------------------------------------------------------------------------


def test_license_notices(spark, odd):
    mit = licenses.TEMPLATES["mit-text"].split()
    edited = " ".join([*mit[:20], "gratis", *mit[21:]])
    texts = {1: "some words before " + NOTICE + " and after", 2: edited, 3: "released under the mit", 4: "x " * 5000 + licenses.TEMPLATES["mit"], 5: " ".join(mit[:30])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.license): r for r in licenses.scan(docs).collect()}
    assert set(got) == {(1, "apache-2"), (2, "mit-text"), (4, "mit")}
    r = got[1, "apache-2"]
    assert texts[1][r.start : r.end] == NOTICE.rstrip(".") and r.containment == 1 and got[2, "mit-text"].containment < 1
    assert {(r.doc_id, r.license) for r in licenses.scan(odd).collect()} == {(None, "apache-2")}
    assert licenses.scan(odd.limit(0)).count() == 0


def plain_notices(text: str, ix) -> list:
    """Every stretch of a text that holds enough of a template, by comparing all shingles with all templates."""
    h, out = licenses.shingle_hashes(re.findall(r"\w+", text.lower()), neardup.WordHashes()), []
    for name, own in zip(ix.names, ix.own, strict=True):
        hits = np.flatnonzero(np.isin(h, own))
        for run in np.split(hits, np.flatnonzero(np.diff(hits) > licenses.BREAK) + 1) if len(hits) else []:
            if len(np.unique(h[run])) / len(own) >= licenses.CONTAINED:
                out.append((name, round(len(np.unique(h[run])) / len(own), 9)))
    return sorted(out)


def test_licenses_are_those_of_a_full_comparison(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ix = licenses.index(licenses.TEMPLATES)
    got = defaultdict(list)
    for r in licenses.scan(docs).collect():
        got[r.doc_id].append((r.license, round(r.containment, 9)))
    want = {r.doc_id: found for r in docs.collect() if (found := plain_notices(r.text or "", ix))}
    assert want and {d: sorted(x) for d, x in got.items()} == want


def test_edited_licenses_are_retrieved_at_the_stated_rate():
    rng = np.random.default_rng(6)
    ix, hashes = licenses.index(licenses.TEMPLATES), neardup.WordHashes()
    some = []
    for k in range(600):
        w = licenses.TEMPLATES[ix.names[k % len(ix.names)]].split()
        for _ in range(int(rng.integers(0, 6))):
            at, kind = int(rng.integers(len(w))), rng.random()
            w[at : at + 1] = ["edited"] if kind < 0.4 else [w[at], "inserted"] if kind < 0.7 or len(w) == 1 else []
        around = [" ".join(f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(0, 300)))) for _ in range(2)]
        some.append(f"{around[0]} {' '.join(w)} {around[1]}")
    some.append(" ".join(some[:80]))  # a text of several parts
    want = [plain_notices(t, ix) for t in some]
    got = [sorted((x[0], round(x[3], 9)) for x in found) for found in licenses.matches(some, ix, hashes)]
    lost = sum(len(set(w) - set(g)) for w, g in zip(want, got, strict=True))
    assert all(set(g) <= set(w) for w, g in zip(want, got, strict=True)) and lost <= 0.003 * sum(map(len, want))
    assert [sorted((x[0], round(x[3], 9)) for x in licenses.find(t, ix, hashes)) for t in some[:50]] == got[:50]  # whatever else is in the batch
    for r in ix.sizes:  # without the bands nothing is found
        r.some[:] = False
    assert not any(licenses.matches(some, ix, hashes))


def test_collision_bound():
    assert min(licenses.collision(n) for n in range(1, 2000)) > 0.997
    for n in range(1, 400):
        size, step = licenses.window(n)
        assert size == n if n <= licenses.EXACT else n + step - 1 <= size <= 1.72 * n
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = licenses.values(h[:300], 64).min(1), licenses.values(h[100:], 64).min(1)
    same = [np.mean(licenses.values(x[:300], 64).min(1) == licenses.values(x[100:], 64).min(1)) for x in (rng.integers(0, 2**63, 400).astype(np.uint64) for _ in range(60))]
    assert len(a) == len(b) == 64 and np.mean(same) == pytest.approx(0.5, abs=0.04)  # minima agree as often as the sets are similar


# --- 8 nearest ---------------------------------------------------------------------------------------------------------


def plain_nearest(vectors, k=20):
    good = [(i, np.array(v, dtype=np.float32)) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, m = np.array([i for i, _ in good]), np.stack([v for _, v in good]).astype(np.float64)
    out = {}
    for n in np.flatnonzero(ids % 20 == 0):
        s = m @ m[n]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[n]][:k]
        out[int(ids[n])] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_nearest_recall_and_scores(spark, hot):
    vectors = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    if hot:  # a third of the rows is one vector, some lengths and values are odd
        vectors += [(1000 + k, vectors[3][1]) for k in range(250)]
        vectors += [(2000, None), (2020, [0.0] * 64), (2040, [1.0] * 63 + [float("nan")]), (2060, [1.0]), (2080, [None] * 64), (2100, [3 * x for x in vectors[7][1]])]
    got = defaultdict(list)
    for r in nearest.search(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = plain_nearest(vectors)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in got)
    exact = {q: dict(v) for q, v in want.items()}
    recall = np.mean([len({i for i, _ in got[q]} & exact[q].keys()) / 20 for q in want])
    assert recall >= 0.9
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q in got for i, s in got[q] if i in exact[q])
    assert all(got[q] == sorted(got[q], key=lambda x: (-x[1], x[0])) for q in got)


def test_nearest_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [0.5, 0.5], "y"), (20, [1.0, 0.0], "z")], "vec_id long, embedding array<float>, list string")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest.search(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert nearest.search(few.limit(0)).count() == 0


def test_nearest_of_double_vectors(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(400, 12)) * rng.uniform(0.2, 3, size=(400, 1))
    found = nearest.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")).collect()
    assert all(r.score == pytest.approx(float(m[r.query_id] @ m[r.vec_id]), rel=1e-14) for r in found)
    near = {q: set(np.argsort(-(m @ m[q]))[:21]) - {q} for q in range(0, 400, 20)}
    assert np.mean([r.vec_id in near[r.query_id] for r in found]) >= 0.9 and len(found) == 20 * 20


def test_nearest_where_probed_lists_hold_too_few(spark, monkeypatch):
    rng = np.random.default_rng(5)
    m = np.repeat(rng.normal(size=(100, 16)), 3, axis=0) + 1e-3 * rng.normal(size=(300, 16))
    fit = nearest.fit
    monkeypatch.setattr(nearest, "fit", lambda good: replace(fit(good), probes=1))
    found = defaultdict(list)
    for r in nearest.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>"), k=60).orderBy("rank").collect():
        found[r.query_id].append(r.vec_id)
    for q in range(0, 300, 20):
        assert found[q] == [int(j) for j in np.argsort(-(m @ m[q]), kind="stable") if j != q][:60]


# --- 10 fingerprints ---------------------------------------------------------------------------------------------------


def test_fingerprints_of_all_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "é"), (10**6 + 3, "ab")], "doc_id long, text string"))
    got = {r.doc_id: r for r in digests.fingerprints(docs).collect()}
    line = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    assert len(got) == len(line)
    for (d, text), (_, following) in zip(line, line[1:] + line[:1], strict=True):
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == digests.digest(text) and r.edited_fingerprint == digests.digest(changed)
        assert r.near_edited == digests.likeness(digests.digest(text), digests.digest(changed))
        assert r.near_next == digests.likeness(digests.digest(text), digests.digest(following))
    long = [got[d] for d, t in line if len(t) > 1000]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.9


def test_triplet_counts_by_hand():
    data = bytes(np.random.default_rng(0).integers(0, 256, 500, dtype=np.uint8))
    want = np.zeros(digests.BUCKETS, dtype=int)
    for i in range(len(data) - 2):
        want[((data[i] | data[i + 1] << 8 | data[i + 2] << 16) * 2654435761 & 0xFFFFFFFF) >> 25] += 1
        if i + 3 < len(data):
            want[((data[i] | data[i + 1] << 8 | data[i + 3] << 16) * 2246822519 & 0xFFFFFFFF) >> 25] += 1
    assert (digests.triplet_counts(data) == want).all()
    old, digests.PIECE = digests.PIECE, 64
    try:
        assert (digests.triplet_counts(data) == want).all()
    finally:
        digests.PIECE = old


def test_fingerprints_of_odd_rows(odd, spark):
    got = digests.fingerprints(odd)
    assert got.count() == odd.count() and digests.fingerprints(odd.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a single text of its own")], "doc_id long, text string")
    r = digests.fingerprints(one).collect()[0]
    assert r.near_next == 1.0 and r.n_chars == 24
    assert digests.likeness(digests.digest("a" * 50), digests.digest("the quick brown fox jumps over the lazy dog")) < 1
