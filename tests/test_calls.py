"""Model calls: window, ledger, runs to a target; order statistics and balanced samples without one task."""

import json
import os
import random
import subprocess
import sys
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sourceground.functions.lookups import TASKS
from sourceground.operators import calls
from sourceground.operators import generate as G
from sourceground.operators import sampling as R
from sourceground.plans import jobs as J
from sourceground.queries import fixtures as D
from sourceground.sources.scratch import scratch_path, stored

JOB = "passage_id string, task_code string, prompt string"


def jobs(spark, n):
    return spark.createDataFrame([(f"p{i}", "T2", f"prompt {i}") for i in range(n)], JOB)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_calls_in_flight_are_tasks_times_window(spark, tmp_path):
    folder = str(tmp_path)

    def client(system, prompt, max_tokens, temperature):
        mine = f"{folder}/on-{uuid.uuid4().hex}"
        Path(mine).touch()
        time.sleep(0.15)
        seen = sum(f.startswith("on-") for f in os.listdir(folder))
        os.remove(mine)
        return str(seen)

    rows = calls.complete(jobs(spark, 240), client, 4, 3).collect()
    seen = [int(r.reply) for r in rows]
    assert len(rows) == 240 and len({r.passage_id for r in rows}) == 240
    assert 4 < max(seen) <= 12


def test_results_come_as_they_finish_and_jobs_are_taken_late():
    taken = []

    def source():
        for n in range(20):
            taken.append(n)
            yield (n,)

    found = calls.sliding(source(), lambda job: (time.sleep(0.3 if job[0] == 0 else 0.0), job[0])[1], 3)
    first = next(found)
    assert first[0][0] != 0 and len(taken) <= 7  # six in hand at most, and the one being taken
    assert sorted([first[1], *(r for _, r in found)]) == list(range(20))


def counted(folder, fail_after=None):
    def client(system, prompt, max_tokens, temperature):
        if fail_after is not None and len(os.listdir(folder)) >= fail_after:
            raise SystemExit  # ends the task as a lost worker does
        Path(f"{folder}/{prompt.replace(' ', '-')}-{uuid.uuid4().hex[:6]}").touch()
        return json.dumps({"answer": prompt})

    return client


def test_a_stopped_run_pays_only_for_what_its_ledger_lacks(spark, tmp_path):
    folder, ledger = str(tmp_path), scratch_path(spark, "ledger")
    table = stored(jobs(spark, 100), "jobs")
    with pytest.raises(Exception, match="SystemExit|exited"):
        calls.complete(table, counted(folder, 60), 2, 2, ledger=ledger, flush=5).collect()
    paid = len(os.listdir(folder))
    kept = calls.read_ledger(spark, ledger).count()
    assert 60 <= paid < 100 and paid - 2 * 5 <= kept <= paid
    twice = calls.complete(table, counted(folder), 3, 2, ledger=ledger, flush=5)
    for _ in range(2):  # the second evaluation calls nothing
        rows = twice.collect()
        assert sorted(json.loads(r.reply)["answer"] for r in rows) == sorted(f"prompt {i}" for i in range(100))
        assert len(os.listdir(folder)) == paid + 100 - kept


RETRY = """
import os, sys
from pathlib import Path
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from sourceground.operators import calls
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.executorEnv.PYTHONPATH", {root!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate()
folder = {folder!r}
def client(system, prompt, max_tokens, temperature):
    if not os.path.exists(folder + "/died") and len(os.listdir(folder)) >= 30:
        Path(folder + "/died").touch()
        os._exit(1)
    Path(folder + "/" + prompt.replace(" ", "-") + "-" + os.urandom(3).hex()).touch()
    return prompt
rows = [("p%d" % i, "T2", "prompt %d" % i) for i in range(80)]
got = calls.complete(spark.createDataFrame(rows, "passage_id string, task_code string, prompt string"), client, 1, 2, ledger={ledger!r}, flush=4).collect()
assert sorted(r.reply for r in got) == sorted(r[2] for r in rows), len(got)
"""


def test_a_task_that_is_run_again_reads_its_own_chunks(tmp_path):
    root, folder = str(Path(__file__).resolve().parent.parent), tmp_path / "calls"
    folder.mkdir()
    script = RETRY.format(root=root, folder=str(folder), ledger=f"file://{tmp_path}/ledger")
    done = subprocess.run([sys.executable, "-c", script], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    called = [f for f in os.listdir(folder) if f != "died"]
    assert 80 <= len(called) <= 80 + 4 + 2  # at most a flush and those in flight are paid twice


def test_first_n_is_a_filter(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice([f"{rng.randrange(16**4):04x}", "abcd", "abce"]), f"p{i}", "x" * 10) for i in range(600)]
    df = stored(spark.createDataFrame(rows, "shuffle string, passage_id string, text string"), "rows")
    for border in (5, 4096):
        monkeypatch.setattr(R, "BORDER", border)
        for n in (0, 1, 7, 250, 599, 600, 900):
            got = R.first_n(df, ["shuffle", "passage_id"], n, already=0)
            assert "TakeOrdered" not in plan(got) and "Exchange" not in plan(got)
            assert sorted(r[:2] for r in got.collect()) == sorted(r[:2] for r in rows)[:n]
    assert R.first_n(df.limit(0), ["shuffle", "passage_id"], 5).count() == 0


def test_balanced_take_of_one_hot_bucket(spark):
    rng = random.Random(4)
    rows = [("T1", "hot" if rng.random() < 0.95 else rng.choice("abc"), i) for i in range(400)]
    order = list(dict.fromkeys(b for _, b, _ in rows))
    held = {b: [i for _, c, i in rows if c == b] for b in order}
    want = [(b, held[b][k]) for k in range(400) for b in order if k < len(held[b])]
    df = spark.createDataFrame(rows, "task_code string, book_id string, i int").repartition(5)
    for n in (0, 3, 60, 399, 1000):
        assert [(r.book_id, r.i) for r in R.balanced_take(df, n, ["i"]).collect()] == want[:n]
    for counts, n in (([5, 2, 9], 10), ([1], 7), ([], 3), ([4, 4], 8), ([3, 3], 0)):
        depth = R.bucket_depth(counts, n)
        assert sum(min(c, depth) for c in counts) >= min(n, sum(counts)) and (not depth or sum(min(c, depth - 1) for c in counts) < n)


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return stored(D.corpus(spark, sf).where("passage_idx < 25"), "run-corpus")


def moody(folder):
    """Fails at first, then answers badly, then well, for some passages; well at once for the others."""

    def client(system, prompt, max_tokens, temperature):
        text = json.loads(prompt[prompt.index('{"source"') :])["raw_text_trad"]
        name = f"{folder}/{uuid.uuid5(uuid.NAMESPACE_URL, prompt)}"
        turn = len(Path(name).read_text()) if os.path.exists(name) else 0
        with open(name, "a") as file:
            file.write("x")
        if len(text) % 3 == 0 and turn < 2:
            if turn == 0:
                raise TimeoutError("busy")
            return "no object"
        return json.dumps({"answer": "甲", "evidence": text[:4] if len(text) % 5 else "無此文字"})

    return client


def test_a_run_ends_at_its_target_and_goes_on(spark, corpus, tmp_path):
    tasks, folder = list(TASKS), scratch_path(spark, "run")
    all_ = stored(G.model_jobs(corpus, tasks).select("passage_id", "task_code", F.length("raw_text_trad").alias("n")), "jobs")
    good = all_.where("n % 5 <> 0").count()
    target = good // 3
    start = lambda **more: J.ModelRun(corpus, tasks, moody(str(tmp_path)), "m", folder, 3, 4, max_retries=0, pause=0.0, **more)
    run = start()
    assert run.step(20) == 20 and run.waves() == 1  # and then the driver is lost
    got = start().run(target)
    assert got.count() == target == got.select("passage_id", "task_code").distinct().count()
    assert got.where("not ok").count() == 0
    calls_ = sum(len(p.read_text()) for p in tmp_path.iterdir())
    assert start().run(target).count() == target and sum(len(p.read_text()) for p in tmp_path.iterdir()) == calls_  # nothing to do
    more = start().run(good + 5, floor=2000)  # more than there are: every job that can be accepted, after its retries
    assert more.count() == good
    errors = start().replies().groupBy("passage_id", "task_code").agg(F.count(F.lit(1)).alias("tries"))
    assert errors.agg(F.max("tries")).first()[0] == 3


def test_a_client_that_always_fails_ends_after_its_tries(spark, corpus):
    def client(system, prompt, max_tokens, temperature):
        raise TimeoutError("busy")

    few = corpus.limit(5)
    run = J.ModelRun(stored(few, "few"), ["T2", "T3"], client, "m", scratch_path(spark, "run"), 2, tries=2, max_retries=0, pause=0.0)
    assert run.run(10).count() == 0
    n = G.model_jobs(few, ["T2", "T3"]).count()
    assert run.replies().count() == 2 * n and run.replies().where("error is null").count() == 0


def test_items_given_as_done_are_counted_and_not_called(spark, corpus, tmp_path):
    all_ = stored(G.model_jobs(corpus, ["T2"]).select("passage_id", "task_code"), "jobs")
    done = all_.orderBy("passage_id").limit(10)
    run = J.ModelRun(corpus, ["T2"], moody(str(tmp_path)), "m", scratch_path(spark, "run"), 2, 4, done=done, max_retries=3, pause=0.0)
    got = run.run(25, floor=5)
    assert got.count() == 15 and got.join(done, ["passage_id", "task_code"], "left_semi").count() == 0
    assert run.replies().join(done, ["passage_id", "task_code"], "left_semi").count() == 0
    assert J.ModelRun(corpus, ["T2"], moody(str(tmp_path)), "m", scratch_path(spark, "run"), 2, done=done).run(10).count() == 0


def test_a_call_costs_little_beside_the_client():
    n = 20_000
    start = time.perf_counter()
    for window in (1, 3):
        found = calls.sliding(((i,) for i in range(n)), lambda job: job[0], window)
        assert sorted(r for _, r in found) == list(range(n))
    assert (time.perf_counter() - start) / (2 * n) < 120e-6
    with pytest.raises(SystemExit):
        list(calls.sliding(((i,) for i in range(50)), lambda job: sys.exit() if job[0] == 20 else 0, 3))


def test_a_ledger_has_few_files(tmp_path, monkeypatch):
    monkeypatch.setattr(calls, "MERGED", 4)
    book = calls.Ledger(f"file://{tmp_path}", 0, 0, 2)
    for i in range(200):
        book.add({"passage_id": f"p{i}", "task_code": "T2", "reply": "甲\n", "attempts": 1})
    book.close()
    names = book.chunk_names()
    assert len(names) < 16  # of 100 chunks
    rows = [r for n in names for r in book.chunk(n)]
    assert sorted(r["passage_id"] for r in rows) == sorted(f"p{i}" for i in range(200)) and {r["reply"] for r in rows} == {"甲\n"}


def test_a_ledger_appends_to_one_file_and_counts_whole_lines(tmp_path):
    book = calls.Ledger(f"file://{tmp_path}", 0, 0, 2)
    made = lambda i: {"passage_id": f"p{i}", "task_code": "T2", "reply": "甲\n", "attempts": 1}
    for i in range(300):
        book.add(made(i))
    book.close()
    assert len(book.chunk_names()) == 1 and len(list(Path(book.folder).iterdir())) == 1  # of 150 flushes
    with open(f"{book.folder}/{book.chunk_names()[0]}", "a") as file:
        file.write('{"passage_id": "p300", "task_c')  # the task is lost
    again = calls.Ledger(f"file://{tmp_path}", 0, 1, 2)
    assert again.paid() == {(f"p{i}", "T2") for i in range(300)}
    again.appends = False  # an object store
    for i in range(300, 400):
        again.add(made(i))
    again.close()
    assert len(again.chunk_names()) < 60 and len(again.paid()) == 400


def test_calls_in_flight_are_dealt_to_the_cores(spark):
    rows = stored(jobs(spark, 60), "jobs")
    for tasks, window, parts in ((1, 8, 4), (1, 3, 3), (2, 3, 4), (6, 2, 6)):
        called = calls.complete(rows, lambda system, prompt, **_: prompt, tasks, window)
        assert called.rdd.getNumPartitions() == parts and called.count() == 60


def test_many_waves_read_the_corpus_a_few_times(spark, corpus, monkeypatch):
    from sourceground.queries.registry import _moody

    tasks, names = list(TASKS), []
    monkeypatch.setattr(J, "stored", lambda df, name, path=None: names.append(name) or stored(df, name, path))
    monkeypatch.setattr(J, "WAVES", 1)
    monkeypatch.setattr(J, "BLOCKS", 2)
    monkeypatch.setattr(J, "SLICE", 100)
    keyed = stored(J.keyed_jobs(corpus, tasks, None, 0).select(*J.JOB_ORDER, F.length("raw_text_trad").alias("n")), "keyed")
    done = keyed.where("n % 7 = 0")
    want = [tuple(r) for r in keyed.where("n % 5 > 2 and n % 7 <> 0").orderBy(*J.JOB_ORDER).select(*calls.KEYS).limit(150).collect()]
    folder, given = scratch_path(spark, "run"), done.count()
    start = lambda: J.ModelRun(corpus, tasks, _moody, "m", folder, 2, 2, done=done, max_retries=0, pause=0.0)
    start().run(given + 40, floor=70, ceiling=70)
    run = start()  # goes on in the same folder
    got = run.run(given + 150, floor=70, ceiling=70)
    assert len(want) == 150 and sorted(tuple(r) for r in got.select(*calls.KEYS).collect()) == sorted(want)
    waves = run.waves()
    assert waves >= 7 and names.count("wave") == waves and 2 <= names.count("block") <= 2 * 3  # two runs
    assert run.replies().groupBy(*calls.KEYS).count().agg(F.max("count")).first()[0] <= 3


def test_waves_move_passages_without_prompts_and_store_no_keys(spark, corpus, monkeypatch):
    from sourceground.operators import model

    wave = J.passages_in_range(corpus, list(TASKS), 0, None, None)
    made = lambda rows: J.prompted(rows.withColumn("task_code", F.explode("__tasks")))
    told = lambda system, prompt, **_: prompt
    called = model.complete(wave, told, 4, later=made)
    above, below = plan(called).split("Exchange", 1)
    assert "prompt#" in above and "explode" in above and "prompt#" not in below and "explode" not in below
    want = sorted(tuple(r) for r in J.prompted(G.model_jobs(corpus, list(TASKS))).select(*calls.KEYS, "prompt").collect())
    assert sorted((r.passage_id, r.task_code, r.reply) for r in called.collect()) == want
    kept = model.complete(wave, told, 4, later=made, ledger=scratch_path(spark, "ledger"))
    assert sorted((r.passage_id, r.task_code, r.reply) for r in kept.collect()) == want
    monkeypatch.setattr(J, "stored", lambda *a: pytest.fail("a wave stores keys"))
    assert len(J.model_waves(corpus, ["T2"], told, "m", 2, 2, store=lambda df: df)) == 2
