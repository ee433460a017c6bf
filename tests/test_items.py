"""Generation, validation, model replies, sampling, reports, streaming."""

import random

import pytest
from pyspark.sql import functions as F

from sourceground.functions.lookups import TASKS
from sourceground.operators import generate as G
from sourceground.operators import model as M
from sourceground.operators import report as A
from sourceground.operators import sampling as R
from sourceground.operators import validate as V
from sourceground.plans import jobs as J
from sourceground.queries import fixtures as D
from sourceground.queries.registry import broken
from sourceground.sources import io
from sourceground.sources.scratch import scratch_path, stored


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return stored(D.corpus(spark, sf), "test-corpus")


def test_deterministic_items_are_valid(corpus):
    checked = V.generate_and_validate(corpus, ["T1", "T6"]).cache()
    assert checked.where("not ok").count() == 0
    assert {r.task_code for r in checked.select("task_code").distinct().collect()} == {"T1", "T6"}
    t6 = checked.where("task_code = 'T6'").where(F.array_contains("evidence.spans", "附子"))
    assert t6.where("safety_note = ''").count() == 0 < t6.count()
    assert checked.select("item_id").distinct().count() == checked.count()
    assert V.generate_and_validate(corpus, []).count() == 0


def test_stored_items_validate_like_fused_ones(corpus):
    items = G.generate_items(corpus, ["T1", "T6"])
    assert V.validate_stored(items, corpus).where("not ok").count() == 0
    lost = V.validate_stored(items, corpus.limit(0))
    assert lost.where("ok").count() == 0


def test_each_fault_is_found(corpus):
    errors = {r.e.split(":")[0] for r in V.validate(broken(corpus)).select(F.explode("errors").alias("e")).distinct().collect()}
    assert errors >= {"span", "external_required", "source_id", "title_missing", "punctuation_changes_text", "few_options", "distractor_without_reason"}


def test_prompts(corpus):
    row = corpus.limit(1)
    prompts = {t: row.select(M.build_prompt(F.lit(t)).alias("p")).first().p for t in (*TASKS, "router", "T99")}
    assert prompts.pop("T99") is None and all(prompts.values())
    expert = row.select(M.build_prompt(F.lit("T3"), "Expert").alias("p")).first().p
    assert expert != prompts["T3"] and "distractors" in prompts["T7"] and "distractors" not in prompts["T3"]


def test_replies_to_items(spark, corpus):
    pid = corpus.first().passage_id
    rows = [
        (pid, "T2", 'So: {"answer": {"x": "附子"}, "evidence": "單"} end'),
        (pid, "T3", "nothing"),
        (pid, "T7", '{"question": "q", "answer": "A", "options": ["A","B","C"], "distractors": [{"option": "B", "exclusion_reason": "", "requires_external": false}]}'),
    ]
    items = {r.task_code: r for r in M.items_from_replies(spark.createDataFrame(rows, "passage_id string, task_code string, reply string"), corpus, "m").collect()}
    assert set(items) == {"T2", "T7"}
    assert items["T2"].answer_json == '{"x":"附子"}' and items["T2"].evidence.spans == ["單"] and items["T2"].safety_note
    assert items["T7"].answer_text == "A" and items["T7"].options == ["A", "B", "C"] and items["T7"].distractors[0].option == "B"


@pytest.mark.parametrize(("answer", "ok"), [('""', False), ("[]", False), ("{}", False), ("null", False), ("0", False), ("-0.0", False), ("false", False), ('"A"', True), ("[0]", True), ('{"x": null}', True), ("2", True), ("true", True), (None, True)])
def test_empty_model_answers_are_none(spark, corpus, answer, ok):
    said = '{"question": "q", "options": ["A","B","C"], "evidence_spans": [null, ""]' + (f', "answer": {answer}' if answer else "") + "}"
    rows = corpus.limit(1).withColumns({"source_text": F.col("raw_text_trad"), "source_normalized": F.col("normalized_text")})
    replies = rows.select("passage_id", F.lit("T7").alias("task_code"), F.lit(said).alias("reply"))
    found = V.validate(M.items_from_replies(replies, rows, "m", carry=("source_text", "source_normalized"))).first()
    assert (found.ok, found.errors) == (ok, [] if ok else ["mcq_without_answer"])
    assert (found.answer_text is None) or (found.answer_json is None)


def test_waves_take_every_job_once(spark, corpus):
    waves = J.model_waves(corpus, list(TASKS), lambda *a, **k: '{"answer": "a"}', "m", 3, 4, store=lambda df: stored(df, "replies"), pause=0.0)
    done = J.union(r for r, _ in waves).select("passage_id", "task_code")
    jobs = G.model_jobs(corpus, list(TASKS)).select("passage_id", "task_code")
    assert len(waves) == 3 and done.count() == done.distinct().count() == jobs.count() and jobs.exceptAll(done).count() == 0


def test_model_calls_and_accounting(spark):
    def flaky(system, prompt, max_tokens, temperature):
        if "T-bad" in prompt:
            raise TimeoutError("busy")
        return "no object" if "T-odd" in prompt else '{"answer": "a"}'

    jobs = spark.createDataFrame([(f"p{i}", "T2", ("T-bad", "T-odd", "T-ok")[i % 3]) for i in range(30)], "passage_id string, task_code string, prompt string")
    replies = stored(M.complete(jobs, flaky, 3, max_retries=2, pause=0.0), "replies")
    assert {r.attempts for r in replies.where("error is not null").collect()} == {3}
    total = M.job_accounting(replies).first()
    assert tuple(total) == (30, 10, 10, 10)
    assert M.job_accounting(replies.limit(0)).first().jobs_total == 0


def test_resume_is_the_exact_remainder(corpus):
    jobs = G.model_jobs(corpus, list(TASKS)).select("passage_id", "task_code").cache()
    done = jobs.where("task_code = 'T12'")
    left = G.model_jobs(corpus, list(TASKS), done)
    assert left.count() + done.count() == jobs.count() and left.where("task_code = 'T12'").count() == 0
    assert jobs.where("task_code in ('T1', 'T6')").count() == 0


def take(items, n):
    """Round robin by a loop."""


    order = list(dict.fromkeys(x[:2] for x in items))
    buckets = {k: [x for x in items if x[:2] == k] for k in order}
    out = []
    while len(out) < n and any(buckets.values()):
        for k in order:
            if buckets[k] and len(out) < n:
                out.append(buckets[k].pop(0))
    return out


def test_balanced_take_matches_a_loop(spark):
    rng = random.Random(5)
    for n in (0, 7, 40, 500):
        rows = [(rng.choice(["T1", "T6"]), rng.choice("abc"), i) for i in range(120)]
        got = R.balanced_take(spark.createDataFrame(rows, "task_code string, book_id string, i int"), n, ["i"]).collect()
        assert [tuple(r) for r in got] == take(rows, n)


def test_release_and_counts(spark, corpus, sf):
    from sourceground.operators.corpus import pilot_table, select_pilots

    full = stored(select_pilots(corpus, pilot_table(spark, D.PILOTS)), "pilots")
    out = J.release(D.files(spark, sf), None, D.DATE, per_book=3, cap=2, full=full)
    stats = out["stats"].collect()
    assert all(r.items_failed == 0 and r.items_generated == r.items_valid for r in stats)
    cited = out["items"].select("passage_id").distinct()
    assert cited.join(out["corpus"], "passage_id", "left_anti").count() == 0
    assert out["items"].groupBy("task_code", "book_id").count().agg(F.max("count")).first()[0] <= 2
    assert out["document"].count() == 1 and out["totals"].where("pilot is null").first().items_generated == sum(r.items_generated for r in stats)
    assert A.books_covered(out["items"]).first().books > 0


def test_jsonl(spark, corpus):
    items = G.generate_items(corpus, ["T1", "T6"]).limit(20)
    path = scratch_path(spark, "jsonl")
    io.write_jsonl(io.with_answer(items), path)
    back = spark.read.text(path).where("value like '%\"answer\":%'")
    assert back.count() == 20
    with_lines = scratch_path(spark, "lines")
    spark.createDataFrame([('{"passage_id":"p","task_code":"T2"}',), ('{"passage_id":"q","task',), ("",)], "value string").write.mode("overwrite").text(with_lines)
    assert [tuple(r) for r in io.read_done(spark, with_lines).collect()] == [("p", "T2")]


def test_streaming_resumes(spark, corpus):
    from sourceground.streaming.items import stream_items, write_items

    base = scratch_path(spark, "stream")
    corpus.repartition(4).write.parquet(f"{base}/in")
    for _ in range(2):  # the rerun adds nothing
        write_items(stream_items(spark, f"{base}/in", corpus.schema, ["T1", "T6"], 1), f"{base}/out", f"{base}/state").awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == G.generate_items(corpus, ["T1", "T6"]).count()


def test_new_items_are_written_once(spark, corpus):
    from sourceground.streaming.items import stream_items, write_new_items

    base = scratch_path(spark, "stream")
    corpus.union(corpus).coalesce(1).write.parquet(f"{base}/in")
    corpus.repartition(2).write.mode("append").parquet(f"{base}/in")
    for k in (0, 1, 0):  # twice on states of their own, then again on the first
        write_new_items(stream_items(spark, f"{base}/in", corpus.schema, ["T1", "T6"], 1), f"{base}/out", f"{base}/state{k}").awaitTermination()
    items = spark.read.parquet(f"{base}/out")
    assert items.count() == items.select("item_id").distinct().count() == G.generate_items(corpus, ["T1", "T6"]).count()
