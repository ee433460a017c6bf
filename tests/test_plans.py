"""Steps that the items' queries share: what they cost a row, told by their plans."""

import re

from pyspark.sql import functions as F
from sourceground.functions import text as X
from sourceground.functions.lookups import PUNCTUATION, SAFETY_HERBS
from sourceground.operators import corpus as C
from sourceground.operators import passages as W
from sourceground.operators import sampling, validate
from sourceground.plans import jobs as J
from sourceground.queries import fixtures as D
from sourceground.queries import registry
from sourceground.sources.scratch import stored


def longest_method(df) -> int:
    spark = df.sparkSession
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


def test_checked_replies_are_methods_that_the_jvm_compiles(spark, sf):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert longest_method(registry.QUERIES["v06_model_answers"](spark, sf)) <= 8000  # the JVM leaves longer ones to its interpreter
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_herbs_and_marks_are_found_without_patterns(spark):
    texts = ["", None, "甲乙", "服附子湯", "附 子", "馬錢", "用馬錢子", "大", "斑蝥。", "a.b", "無點", *SAFETY_HERBS, *PUNCTUATION]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", X.mentions_restricted_herb(F.col("t")).alias("herb"), X.has_punctuation(F.col("t")).alias("marked"))
    assert "RLIKE" not in found._jdf.queryExecution().optimizedPlan().toString()
    for t, herb, marked in found.collect():
        assert herb == bool(t and re.search("|".join(SAFETY_HERBS), t))
        assert marked == (None if t is None else any(c in PUNCTUATION for c in t))


def test_a_table_in_one_file_is_dealt_to_all_tasks(spark, tmp_path):
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2(F.concat_ws(":", "id", i), 256)))
    spark.range(2000).select(F.col("id").alias("doc_id"), text.alias("text"), F.concat(F.lit("src"), F.col("id") % 5).alias("source")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = D.source_files(spark, str(tmp_path))
    assert len(found.inputFiles()) > 1 and found.count() == 2000 + 5 + 1


def test_listed_pilots_need_no_python_worker(spark):
    table = C.pilot_table(spark, {"a": ["x", "y"], "b": ["x"]})
    assert [tuple(r) for r in table.collect()] == [("a", 0, "x", 0), ("a", 0, "y", 1), ("b", 1, "x", 0)]
    assert C.pilot_table(spark, {}).collect() == []
    assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()


def test_a_release_stores_no_text_of_what_it_does_not_release(spark, sf, monkeypatch):
    kept = {}
    monkeypatch.setattr(J, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    out = J.release(D.files(spark, sf), None, D.DATE, per_book=3, cap=2, full=D.pilot_corpus(spark, sf))
    assert kept and not {"raw_text_trad", "raw_text_simp", "normalized_text", "context", "answer_text", "evidence"} & {c for df in kept.values() for c in df.columns}
    full = stored(D.pilot_corpus(spark, sf), "corpus")
    checked = validate.generate_and_validate(full, ["T1", "T6"], carry=J.CARRY)
    capped = stored(sampling.cap_items(checked.where("ok"), 2, J.ORDER), "capped")
    key = [c for c in capped.columns if c not in ("distractors", "evidence", "answer_formula")]
    assert out["items"].select(*key).collect() == capped.select(*key).collect()  # the same items in the same order
    whole = sampling.release_corpus(full, sampling.balanced_sample(full, 3), capped)
    assert sorted(r.passage_id for r in out["corpus"].collect()) == sorted(r.passage_id for r in whole.collect())
    assert out["corpus"].columns == full.columns and out["items"].columns == capped.columns


def test_lists_that_share_a_book_make_a_release_of_each(spark, sf):
    shared = {"a": ["src1", "src0"], "b": ["src0", "src3"]}
    pilots = C.pilot_table(spark, shared)
    full = C.ingest(D.source_files(spark, sf, pilots), D.DATE, pilots=pilots)
    joined = C.select_pilots(D.corpus(spark, sf), pilots)
    key = ["pilot", "pilot_ord", "book_ord", "passage_id", "normalized_text", "book_title_trad"]
    assert sorted(full.select(*key).collect()) == sorted(joined.select(*key).collect())
    out = J.release(D.files(spark, sf), None, D.DATE, cap=4, full=full)
    capped = sampling.cap_items(validate.generate_and_validate(stored(joined, "joined"), ["T1", "T6"], carry=J.CARRY).where("ok"), 4, J.ORDER)
    assert [(r.pilot, r.item_id) for r in out["items"].collect()] == [(r.pilot, r.item_id) for r in capped.collect()]
    counted = {r.pilot: r["count"] for r in joined.groupBy("pilot").count().collect()}
    assert {r.pilot: r.passages_full for r in out["stats"].collect()} == counted


def test_marks_that_change_the_text_are_found(spark):
    rows = [("甲，乙。", "甲乙"), ("甲，乙。", "甲。乙"), ("甲，乙。", "甲丙"), ("甲，乙。", None), ("，", ""), ("，", None), (None, "甲"), ("甲", "甲 ")]
    items = spark.createDataFrame([(*r, "punctuation_restoration") for r in rows], "answer_text string, context string, task string")
    found = [r.e for r in items.select(validate.punctuation_errors().alias("e")).collect()]
    assert found == [[], [], ["punctuation_changes_text"], ["punctuation_changes_text"], [], [], ["answer_not_text"], ["punctuation_changes_text"]]


def test_texts_move_once_to_numbers_that_are_too_many_to_send(spark, sf, monkeypatch):
    kept = []
    monkeypatch.setattr(W, "stored", lambda df, name: kept.append(name) or stored(df, name))
    sent = D.pilot_corpus(spark, sf).select("passage_id", "heading_path", "formulas")
    assert "numbered" not in kept
    monkeypatch.setattr(W, "SENT_NUMBERS", 0)
    moved = D.pilot_corpus(spark, sf).select("passage_id", "heading_path", "formulas")
    assert "numbered" in kept and sorted(moved.collect()) == sorted(sent.collect())
