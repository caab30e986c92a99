"""The corpus pipeline, stage by stage, against plain versions of each stage."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from catalogflow.llm import mixing, personal, quality
from catalogflow.llm.common import staged
from catalogflow.llm.queries import word_tokenizer
from tests.llm.test_operators import plain_classes

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_registration():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "personal_data", "mixture", "packing"] and corpus_pipeline.ORACLE_SQL is None
    queries = __spark_entry__.queries()
    assert "pipeline" in queries and sorted(int(n[2:].split("_")[0]) for n in queries if n.startswith("op")) == list(range(1, 14))


def test_pipeline_against_plain_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, FOLDER), f"test-{name}")
        assert out.columns == docs.columns
        kept[name] = (docs.collect(), out.collect())
        docs = out
    before, after = kept["quality"]
    model = quality.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = model.score(quality.pooled([r.text for r in before], model.vectors, quality.Buckets()))
    assert {r.doc_id for r in after} == {r.doc_id for r, s in zip(before, scores, strict=True) if s >= 0.7} and len(after) < len(before)

    before, after = kept["near_duplicates"]
    classes = plain_classes({r.doc_id: r.text for r in before})
    assert {r.doc_id for r in after} == {d for d, c in classes.items() if d == c} and len(after) < len(before)
    given = {r.doc_id: r for r in before}
    assert all(given[r.doc_id] == r for r in after)

    before, after = kept["personal_data"]
    texts = {r.doc_id: r.text for r in after}
    assert texts.keys() == {r.doc_id for r in before}
    assert not [d for d, t in texts.items() if personal.base_spans(t)]
    assert all(texts[r.doc_id] == r.text for r in before if not any(c.isdigit() or c == "@" for c in r.text))
    assert any(texts[r.doc_id] != r.text for r in before) and all(r.n_chars == len(r.text) for r in after)

    before, after = kept["mixture"]
    assert Counter(before) == Counter(after)
    order = mixing.mix(spark.createDataFrame(before)).orderBy("slot", "place").select("doc_id")
    rows = docs.select("doc_id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")).orderBy("f", "r")
    assert [r.doc_id for r in rows.collect()] == [r.doc_id for r in order.collect()]

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    plain = Tokenizer.from_file(word_tokenizer())
    got = {d: np.concatenate([np.frombuffer(b, dtype="<u4") for b in g.sort_values("start").ids]).tolist() for d, g in pieces.groupby("doc_id")}
    assert got == {r.doc_id: plain.encode(r.text, add_special_tokens=False).ids + [2] for r in after}
    assert pieces.groupby("sequence_id").length.sum().max() <= 4096
    _follow_the_mixture(pieces, {r.doc_id: n for n, r in enumerate(rows.collect())})


def _follow_the_mixture(pieces, position):
    """Pools in the order of their places hold documents in the order of the mixture, whichever task read them."""
    pools = pieces.groupby(["pool_file", "pool_row"]).doc_id.agg(lambda d: [min(map(position.get, d)), max(map(position.get, d))]).sort_index()
    assert all(a[1] < b[0] for a, b in zip(pools, pools[1:]))
    assert pieces.groupby("sequence_id").pool_row.nunique().max() == 1


def test_sequences_follow_the_mixture_over_many_files(spark, out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix(docs).repartitionByRange(16, "slot", "place").sortWithinPartitions("slot", "place").select(*docs.columns)
    mixed.write.parquet(f"{out}/mixed")
    written = spark.read.parquet(f"{out}/mixed")
    pieces = corpus_pipeline.packing_stage(spark, written, FOLDER).toPandas()
    order = written.select("doc_id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("r")).orderBy("f", "r").collect()
    assert pieces.pool_file.nunique() > 8
    _follow_the_mixture(pieces, {r.doc_id: n for n, r in enumerate(order)})


def test_run_gives_the_last_stage(spark, out):
    """All stages from end to end, on documents with a null and an empty text."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(10**7, None, None, None, None), (10**7 + 1, "", "en", "src0", 0)], docs.schema)
    docs.unionByName(odd).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{out}/labels.parquet")
    got = corpus_pipeline.run(spark, out)
    assert got.count() > 0 and set(got.columns) >= {"doc_id", "sequence_id", "start", "length", "offset"}
