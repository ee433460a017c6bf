"""Classifiers on held-out rows, and the pipeline against its stages' laws."""

import random
import zlib

import numpy as np

import corpus_pipeline
from sourceground.llm import decontaminate, quality, toxicity
from sourceground.llm.labelled import training_sample
from sourceground.llm.registry import ORACLE_SQL, QUERIES

TRAIN = "/root/testdata/sf0.1"


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    fm = quality.FactorisationMachine(0.3, rng.normal(size=quality.BUCKETS + len(quality.STATS)), rng.normal(size=(quality.BUCKETS + len(quality.STATS), quality.RANK)), np.zeros(len(quality.STATS)), np.ones(len(quality.STATS)))
    idx, x = np.array([5, 9, 700, 16390]), np.array([0.5, -1.0, 2.0, 0.25])
    v = fm.factors[idx]
    pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(4) for j in range(i))
    assert abs(fm.margin(idx, x) - (0.3 + fm.linear[idx] @ x + pairs)) < 1e-9


def held(i, modulus, remainder):
    return zlib.crc32(str(i).encode()) % modulus == remainder


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{TRAIN}/documents.parquet"), spark.read.parquet(f"{TRAIN}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(docs.join(labels.select("doc_id"), "doc_id"), labels, per_class=500).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == held(i, 4, 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    out = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].predicted == truth[i] for i in out]) > 0.97


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{TRAIN}/documents.parquet"), spark.read.parquet(f"{TRAIN}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.classify(docs.join(labels.select("doc_id"), "doc_id"), labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = [i for i, r in got.items() if r.held_out == held(i, 5, 0) and r.held_out]
    assert np.mean([got[i].predicted == truth[i] for i in out]) > 0.97


def test_classifiers_on_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "x", "s", None), (2, "", "x", "s", 0), (None, "word " * 100_000, "x", "s", 5), (2, "", "x", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as score", "2 as y")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for f in (quality.classify, toxicity.classify):
        rows = f(docs, labels).collect()
        assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
        assert f(docs.limit(0), labels.limit(0)).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns and quality.keep_good(docs, labels).count() == 4  # nothing learnt, nothing lost


def test_repeated_labelled_ids_are_one_sample_row(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i % 7} of {i}", 9) for i in range(300)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)] * 5, "doc_id long, quality int")
    rows, sizes = training_sample(docs, labels, "quality", 4, 2, 2)
    assert rows.count() == rows.select("doc_id").distinct().count() == sum(sizes.values())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_quotation_scores_lower():
    model = toxicity.ToxicityModel({"idiot": 1.5}, {})
    abuse, quoted = model.score("you are an idiot"), model.score('he said the word "idiot" was used')
    assert abuse > 0.5 > quoted
    assert model.score("you are an id1iot") > model.score("a plain line")


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, kept, sf).cache()
        assert after.columns == docs.columns and after.subtract(kept).count() == 0, name
        kept = after
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not decontaminate.Index(items).search([r.text for r in kept.collect()])
    mixed = corpus_pipeline.STAGES[3][1](spark, kept, sf).cache()
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 2").count() == 0
    final = corpus_pipeline.run(spark, sf).cache()
    assert final.select(*docs.columns).exceptAll(mixed).count() == mixed.exceptAll(final.select(*docs.columns)).count() == 0
    check_shards(final)


def check_shards(final):
    shards = {}
    for r in final.collect():
        assert r["size"] == len((r.text or "").encode()) + 1
        shards.setdefault(r.shard, []).append(r)
    total, largest = sum(r["size"] for rs in shards.values() for r in rs), max(r["size"] for rs in shards.values() for r in rs)
    for rs in shards.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs))) and abs(sum(r["size"] for r in rs) - total / 8) <= largest


def test_pipeline_on_odd_documents(spark, tmp_path):
    """Nulls in every column, empty texts, repeated rows and ids, no labels, a clashing column, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string"
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 211}" for k in range(30)), "en", "ab"[i % 2], 9, 1, "x") for i in range(40)]
    rows += [(None, None, None, None, None, None, None), (None, "", "en", None, 0, 1, "x"), rows[3], rows[3], (5, "another text that has the same id", None, "a", 1, 1, "x"), (99, "word " * 20_000, "en", "b", 1, 1, "x")]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[0][1]), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
    kept = docs.collect()
    assert sorted(r.doc_id for r in kept if r.text and r.doc_id is not None) == [*range(1, 6), 5, *range(6, 40), 99]
    assert sum(not r.text for r in kept) == 1
    final = corpus_pipeline.run(spark, str(tmp_path))
    check_shards(final)
    assert {r.text for r in final.collect() if r.text} <= {r.text for r in kept}
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0


def test_registry():
    assert len(QUERIES) == 10 and set(ORACLE_SQL) <= set(QUERIES)
