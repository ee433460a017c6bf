"""Split files, fragments of passages, schema documents, spans, buckets, keyed streams."""

import random

import pytest
from pyspark.sql import functions as F

from sourceground.operators import conformance as K
from sourceground.operators import corpus as C
from sourceground.operators import generate as G
from sourceground.operators import passages as W
from sourceground.operators import validate as V
from sourceground.plans import jobs as J
from sourceground.queries import fixtures as D
from sourceground.sources import books as S
from sourceground.sources import splits
from sourceground.sources.scratch import scratch_path, stored, stored_by


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return stored(D.corpus(spark, sf), "stored-corpus")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PIECES = ["文", "甲乙", "\n", "\n", "\r\n", "\r", "\x0b", "\x1c", " ", " ", "<book>", "</book>", "書名=x", "=== t ==="]


def test_lines_of_split_files(spark, tmp_path):
    """Any line ends, bad bytes, metadata blocks anywhere: the same lines as from whole files, however the files are cut."""
    rng = random.Random(7)
    for n in range(12):
        book = tmp_path / f"書 {n}+a"
        book.mkdir()
        (book / "index.txt").write_bytes("".join(rng.choices(PIECES, k=rng.randint(0, 40))).encode())
        for k in range(rng.randint(0, 3)):
            data = "".join(rng.choices(PIECES[:10], k=rng.choice([0, 3, 60, 400]))).encode()
            (book / f"{k + 1}.txt").write_bytes(data + (b"\xff" if k == 2 else b""))
        if n % 3 == 0:
            (book / "menu.txt").write_text("<menu>\n2|b\n1|a\n1|again\n</menu>")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "1.txt").write_text("no index")
    whole = S.read_book_files(spark, str(tmp_path))
    key = lambda rows: sorted(tuple(r) for r in rows)
    want = key(S.book_lines(whole).collect())
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for size in ("128m", "64"):
        before = {n: spark.conf.get(n) for n in names}
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "4m" if size == "128m" else "0")
        try:
            files, lines = splits.read_books(spark, str(tmp_path))
            assert key(lines.collect()) == want
            assert key(S.catalog(files).select("book_id", "book_title_trad").collect()) == key(S.catalog(whole).select("book_id", "book_title_trad").collect())
        finally:
            for n, v in before.items():
                spark.conf.set(n, v)


def test_a_block_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(W, "PART", 4)
    lines = ["=== t ===", "<F>", *[f"line {n}" for n in range(50)], "</F>", "", "after"]
    rows = spark.createDataFrame([("b", n, s) for n, s in enumerate(lines, 1)], "book_id string, line_no long, line string").repartition(3)
    got = W.passages(rows).orderBy("passage_idx").collect()
    assert [r.raw_joined for r in got] == ["\n".join(lines[1:53]), "after"] and [r.heading_path for r in got] == [["t"], ["t"]]


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, []),
        ({"answer": None}, ["missing:answer"]),
        ({"options": ["甲", 2, None]}, ["type:options[1]:integer", "type:options[2]:null"]),
        ({"evidence": "單"}, ["type:evidence:string"]),
        ({"evidence": {"source_id": "x", "spans": [1]}}, ["missing:evidence.book_title_trad", "constant:evidence.source_id", "type:evidence.spans[0]:integer"]),
        ({"distractors": [{"requires_external": "no", "option": 1}, 3]}, ["type:distractors[0].option:integer", "type:distractors[0].requires_external:string", "type:distractors[1]:integer"]),
        ({"task_code": "T99", "difficulty": 1}, ["enum:task_code:T99", "enum:difficulty:1"]),
        ({"context": None}, ["type:context:null"]),
        ({"answer": [{"x": 1}], "unknown": 5}, []),
    ],
)
def test_documents_against_their_schema(spark, change, want):
    import json

    item = {"item_id": "i", "task": "t", "task_code": "T2", "question": "q", "answer": "a", "evidence": {"book_title_trad": "b", "source_id": K.ITEM["properties"]["source_id"]["const"], "chapter": None}, "book_id": "b", "passage_id": "p", "inference_level": "direct", "source_id": K.ITEM["properties"]["source_id"]["const"]}
    df = spark.createDataFrame([(json.dumps(item | change),)], "line string")
    assert df.select(K.document_violations(K.ITEM, F.try_parse_json("line")).alias("v")).first().v == want


def test_what_is_no_object_breaks_every_schema(spark):
    df = spark.createDataFrame([("[]",), ("broken",), (None,)], "line string")
    assert [r.v for r in df.select(K.document_violations(K.ITEM, F.try_parse_json("line")).alias("v")).collect()] == [["type:$:array"], ["missing:$"], ["missing:$"]]


def test_generated_rows_conform(corpus):
    assert K.corpus_violations(corpus).count() == 0
    assert K.item_violations(G.generate_items(corpus, ["T1", "T6"])).count() == 0


@pytest.mark.parametrize(
    ("answer", "errors"),
    [
        ('{"formula_name": "INVENTED", "ingredients": [{"herb": "NOHERB", "dose": "9 tons"}]}', ["name:INVENTED", "herb:NOHERB", "dose:9 tons"]),
        ('{"formula_name": "", "ingredients": [{"herb": null, "dose": 77777}]}', ["dose:77777"]),
        ('{"ingredients": "none"}', []),
        ('"INVENTED"', []),
        ("[1]", []),
    ],
)
def test_formulas_of_models_are_grounded(spark, corpus, answer, errors):
    one = stored(corpus.limit(1), "one")
    for said in (f'{{"task": "formula_structure_parsing", "answer": {answer}}}', *([f'{{"task": "formula_structure_parsing", {answer[1:]}'] if answer.startswith("{") else [])):
        found = J.judged(one, one.select("passage_id", F.lit("T2").alias("task_code"), F.lit(said).alias("reply")), "m").first()
        assert (found.errors, found.ok) == (errors, not errors)


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_spans_against_brute_force(spark, most):
    rng = random.Random(11)
    texts = [None, "", *("".join(rng.choices("甲乙丙", k=rng.randint(1, 60))) for _ in range(60))]
    corpus = stored(spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "passage_id string, normalized_text string"), "texts")
    spans = [(i, "".join(rng.choices("甲乙丙，", k=rng.randint(0, 6)))) for i in range(80)] + [(99, None), (7, "甲乙"), (7, "甲乙")]
    got = C.trace_spans(spark.createDataFrame(spans, "span_id long, span string"), corpus, most)
    want = {(i, f"p{k}") for i, s in spans if s and s.replace("，", "") for k, t in enumerate(texts) if t and s.replace("，", "") in t}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert "SortMergeJoin" not in plan(got) and "normalized_text" not in "".join(x for x in plan(got).splitlines() if "Exchange" in x)


def test_bucketed_tables_join_without_exchange(spark, corpus):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = stored_by(G.generate_items(corpus, ["T1", "T6"]), "items", "passage_id", 4)
        checked = V.validate_stored(items, stored_by(corpus, "corpus", "passage_id", 4))
        assert "Exchange" not in plan(checked)
        assert checked.where("ok").count() == items.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keyed_state_reads_no_sink(spark, corpus):
    from sourceground.streaming.items import stream_keyed_items, write_keyed_items

    base = scratch_path(spark, "stream")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    corpus.where("passage_idx % 2 = 0").write.parquet(f"{base}/in")
    for part in (corpus, corpus.limit(0)):
        items = stream_keyed_items(spark, f"{base}/in", corpus.schema, ["T1", "T6"], max_files=1)
        write_keyed_items(items, f"{base}/out", f"{base}/state").awaitTermination()
        part.write.mode("append").parquet(f"{base}/in")
    found = spark.read.parquet(f"{base}/out")
    assert found.count() == found.select("item_id").distinct().count() == G.generate_items(corpus, ["T1", "T6"]).count()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for book in ("a", "b"):
        (tmp_path / book).mkdir()
        for i in range(400):
            (tmp_path / book / f"{i}.txt").write_text(f"{i}\n{book}")
        (tmp_path / book / "index.txt").write_text("<book>\n</book>")
        (tmp_path / book / "note.md").write_text("no book file")
    raw = spark.read.format("text").load(**S.folders(str(tmp_path)))
    most = S.READERS * spark.sparkContext.defaultParallelism
    assert raw.count() == 2 * (2 * 400 + 2) and raw.rdd.getNumPartitions() > most >= S.packed(raw).rdd.getNumPartitions()
    want = {(b, 2 * i + k + 1, line) for b in ("a", "b") for i in range(400) for k, line in enumerate((str(i), b))}
    assert {tuple(r) for r in splits.read_books(spark, str(tmp_path))[1].collect()} == want


def test_small_ranges_and_chunks_give_the_same_lines(spark, tmp_path, monkeypatch):
    """Files are listed and read by tasks, in ranges and chunks of any size; the driver's readers are not asked for a file."""
    rng = random.Random(5)
    for n in range(3):
        book = tmp_path / f"b{n}"
        book.mkdir()
        (book / "index.txt").write_bytes("".join(rng.choices(PIECES, k=rng.randint(1, 30))).encode())
        for k in range(3):
            (book / f"{k + 1}.txt").write_bytes("".join(rng.choices(PIECES[:10], k=rng.choice([1, 9, 90]))).encode() + (b"\xff\r\r" if k == 2 else b""))
    for path in tmp_path.glob("*/*.txt"):
        data = path.read_bytes()
        for length, most in ((1, 3), (5, 2), (64, 7), (999, 1000)):
            got = []
            for block in range(0, len(data), length):
                with open(path, "rb") as file:
                    got += list(splits._chunks(file, block, len(data), length, most))
            assert b"".join(d for d, _ in got) == data and [e for _, e in got] == [False] * (len(got) - 1) + [True]
            assert all(d.endswith(b"\n") for d, _ in got[:-1])
    monkeypatch.setattr(splits, "RANGE", 40)
    monkeypatch.setattr(splits, "READ", 16)
    want = sorted(tuple(r) for r in S.book_lines(S.read_book_files(spark, str(tmp_path))).collect())
    assert sorted(tuple(r) for r in splits.read_books(spark, str(tmp_path))[1].collect()) == want
    listed = splits.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in listed and "MapInArrow" in listed
