"""Calls of a model client from inside tasks: a sliding window of calls, and a ledger of paid replies.

Calls in flight are ``tasks * window`` at most, however many cores the executors have. They
are dealt to as many tasks as there are cores, so a task has a share of them (its window) and the
same share of the jobs. It keeps at most twice its window in hand, takes the next job when one is
done and hands results on as they finish.

The ledger is a shared folder. A task appends the replies that it has paid for to chunk
files, a line each; a line counts when it is whole. Where a file cannot be appended to, each
flush is a chunk, and ``MERGED`` chunks of a level become one of the next, so files stay few.
A task that is run again reads its own chunks and calls what is missing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from queue import Empty, SimpleQueue
from threading import Thread

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import exists

KEYS = ["passage_id", "task_code"]
REPLIES = "passage_id string, task_code string, reply string, error string, attempts int"
#: Results that a task hands on together.
HANDED = 64
RESULTS = pa.schema([("passage_id", pa.string()), ("task_code", pa.string()), ("reply", pa.string()), ("error", pa.string()), ("attempts", pa.int32())])
#: After so many calls in a row that took under so many seconds, a task makes them one at a time and without its threads.
QUICK, QUICK_S = 32, 0.002
#: Chunks of one level of a ledger that become one of the next, and the highest level. A chunk that is appended to holds as many flushes as one of that level.
MERGED, LEVELS = 64, 2
_line = json.JSONEncoder(ensure_ascii=False).encode


def call(client: Callable[..., str], system: str, prompt: str, max_retries: int, pause: float, **options) -> tuple[str | None, str | None, int]:
    """(reply, error, attempts): tried again after 1, 2, 4 ... at most 16 times ``pause`` seconds; the last error is kept."""
    attempt, delay = 0, 1.0
    while True:
        attempt += 1
        try:
            return client(system, prompt, **options), None, attempt
        except Exception as e:  # noqa: BLE001  any client, any error
            if attempt > max_retries:
                return None, f"{type(e).__name__}: {e}", attempt
        if pause:
            time.sleep(pause * min(delay, 16.0))
        delay *= 2


def sliding(jobs: Iterator[tuple], work: Callable[..., tuple], window: int) -> Iterator[tuple]:
    """(job, result) as they finish: ``window`` threads, and as many jobs again waiting for them.

    While calls are quick (a cache, a ledger, a stub), handing them over would cost more than
    they do: the consumer makes them itself until one is slow. What ``work`` raises is raised here.
    """
    todo, done, quick = SimpleQueue(), SimpleQueue(), 0

    def serve() -> None:
        while (job := todo.get()) is not None:
            start = time.perf_counter()
            try:
                done.put((job, work(job), None, time.perf_counter() - start))
            except BaseException as e:  # noqa: BLE001  raised again by the consumer
                done.put((job, None, e, 0.0))

    def taken(job: tuple, result: tuple, error: BaseException | None, seconds: float) -> tuple:
        nonlocal quick
        quick = quick + 1 if seconds < QUICK_S else 0
        if error is not None:
            raise error
        return job, result

    threads = [Thread(target=serve, daemon=True) for _ in range(window)]
    for t in threads:
        t.start()
    held = 0
    try:
        for job in jobs:
            if quick >= QUICK:
                while held:
                    held -= 1
                    yield taken(*done.get())
                start = time.perf_counter()
                result = work(job)
                yield taken(job, result, None, time.perf_counter() - start)
                continue
            todo.put(job)
            held += 1
            if held >= 2 * window:
                found = [done.get()]
                try:
                    while True:
                        found.append(done.get_nowait())
                except Empty:
                    pass
                held -= len(found)
                for f in found:
                    yield taken(*f)
        for _ in range(held):
            yield taken(*done.get())
    finally:
        try:
            while True:  # what nobody waits for is not called
                todo.get_nowait()
        except Empty:
            pass
        for _ in threads:
            todo.put(None)
        for t in threads:
            t.join()


class Ledger:
    """One task's chunk files below ``root``, a URI that ``pyarrow.fs`` opens on the executors."""

    def __init__(self, root: str, part: int, attempt: int, flush: int):
        import pyarrow.fs as pafs

        self.fs, base = pafs.FileSystem.from_uri(root)
        self.folder, self.attempt, self.flush, self.held, self.chunks = f"{base}/part={part:05d}", attempt, flush, [], 0
        self.appends, self.open, self.appended = True, None, 0  # can files be appended to, the chunk that is, its flushes
        self.whole: list[list[str]] = [[] for _ in range(LEVELS + 1)]  # this attempt's chunks that were not appended to, by level
        self.fs.create_dir(self.folder, recursive=True)

    def _read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.folder}/{name}") as file:
            return file.read()

    def chunk_names(self) -> list[str]:
        import pyarrow.fs as pafs

        return sorted(f.base_name for f in self.fs.get_file_info(pafs.FileSelector(self.folder)) if f.base_name.endswith(".jsonl"))

    def chunk(self, name: str) -> list[dict]:
        """The replies in the whole lines of a chunk; a lost task may have left half a line at its end."""
        return [json.loads(line) for line in self._read(name).split(b"\n")[:-1]]

    def paid(self) -> set[tuple[str, str]]:
        """Keys of all replies in this task's chunks; the replies themselves stay on disk."""
        return {(r["passage_id"], r["task_code"]) for name in self.chunk_names() for r in self.chunk(name)}

    def add(self, row: dict) -> None:
        self.held.append(row)
        if len(self.held) >= self.flush:
            self.close()

    def close(self) -> None:
        if self.held:
            data = "".join([_line(r) + "\n" for r in self.held]).encode()
            if not (self.appends and self._append(data)):
                self._keep(0, [data])
            self.held = []

    def _name(self) -> str:
        self.chunks += 1
        return f"chunk-{self.attempt:03d}-{self.chunks:07d}-{uuid.uuid4().hex[:8]}.jsonl"

    def _append(self, data: bytes) -> bool:
        """Is ``data`` now at the end of this attempt's chunk, in a file that is closed?"""
        if self.open is None or self.appended >= MERGED**LEVELS:
            self.open, self.appended = self._name(), 0
        try:
            out = self.fs.open_append_stream(f"{self.folder}/{self.open}")
        except NotImplementedError:  # an object store
            self.appends = False
            return False
        with out:
            out.write(data)
        self.appended += 1
        return True

    def _keep(self, level: int, parts: list[bytes] | Iterator[bytes]) -> None:
        """Writes a chunk; chunks that are enough for one of the next level become it and are deleted after it is whole."""
        name = self._name()
        with self.fs.open_output_stream(f"{self.folder}/{name}") as out:
            for data in parts:
                out.write(data)
        self.whole[level].append(name)
        if level < LEVELS and len(self.whole[level]) >= MERGED:
            merged, self.whole[level] = self.whole[level], []
            self._keep(level + 1, (self._read(m) for m in merged))
            for m in merged:
                self.fs.delete_file(f"{self.folder}/{m}")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(passage_id, task_code, reply, error, attempts) of every reply below ``root``, once for each key; none if there is no ledger."""
    if not exists(spark, root):
        return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in REPLIES.split(", "))])
    rows = spark.read.schema("passage_id string, task_code string, reply string, attempts int").option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").option("ignoreMissingFiles", "true").json(root)  # a chunk that has just been merged is asked for again
    whole = rows.where("reply is not null").repartition(*KEYS).groupBy(*KEYS).agg(F.min(F.struct("attempts", "reply")).alias("r"))
    return whole.select(*KEYS, "r.reply", F.lit(None).cast("string").alias("error"), "r.attempts")


def complete(
    jobs: DataFrame, client: Callable[..., str], tasks: int, window: int = 8, ledger: str | None = None, flush: int = 16,
    max_retries: int = 4, max_tokens: int = 2048, temperature: float = 0.0, pause: float = 1.0, system: str = "",
    later: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Calls ``client(system, prompt, max_tokens=, temperature=)`` once for each job (passage_id, task_code, prompt).

    Returns (passage_id, task_code, reply, error, attempts) for every job. ``tasks * window``
    calls are in flight at most; the client is called from ``window`` threads at a time. Failed
    calls are tried again and at last kept with their error, never raised.

    With ``ledger``, a folder that all executors reach, jobs whose replies it holds are not
    called; a task that is lost calls only what its chunks lack, and so does a result that is
    computed twice. At most ``tasks * flush`` replies of lost tasks are paid twice, and those in
    flight. Errors are not paid and not kept. Without a ledger, store the result before using it.

    With ``later``, ``jobs`` are rows of any columns beside their keys, and it makes the prompt
    of them once they are with the tasks that call: prompts are not moved. They may also be
    rows of a passage (passage_id), which it makes into jobs, with a ledger before they are dealt.
    """
    slots = tasks * window
    parts = min(slots, max(tasks, jobs.sparkSession.sparkContext.defaultParallelism))
    part_flush = max(1, flush * tasks // parts)
    if later and ledger and "task_code" not in jobs.columns:
        jobs, later = later(jobs), None
    wanted = jobs if later else jobs.select(*KEYS, "prompt")
    before = None
    run_folder = None
    if ledger:
        if exists(jobs.sparkSession, ledger):
            before = read_ledger(jobs.sparkSession, ledger)
            wanted = wanted.join(before.select(*KEYS), KEYS, "left_anti")
        run_folder = f"{ledger.rstrip('/')}/run-{uuid.uuid4().hex}"

    def run(batches):
        book, paid, again = None, set(), set()
        context = TaskContext.get()
        own = sum(slot * parts // slots == context.partitionId() for slot in range(slots))
        if run_folder:
            book = Ledger(run_folder, context.partitionId(), context.attemptNumber(), part_flush)
            paid = book.paid()

        def asked() -> Iterator[tuple]:
            for batch in batches:
                for key in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "prompt")), strict=True):
                    if key[:2] in paid:
                        again.add(key[:2])
                    else:
                        yield key

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RESULTS, strict=True)], schema=RESULTS)

        rows: list[tuple] = []
        work = lambda job: call(client, system, job[2], max_retries, pause, max_tokens=max_tokens, temperature=temperature)
        try:
            for job, (reply, error, attempts) in sliding(asked(), work, own):
                if book and error is None:
                    book.add({"passage_id": job[0], "task_code": job[1], "reply": reply, "attempts": attempts})
                rows.append((*job[:2], reply, error, attempts))
                if len(rows) >= HANDED:
                    yield table(rows)
                    rows = []
        finally:
            if book:
                book.close()
        if rows:
            yield table(rows)
        for name in book.chunk_names() if again else ():
            found = [(r["passage_id"], r["task_code"], r["reply"], None, r["attempts"]) for r in book.chunk(name) if (r["passage_id"], r["task_code"]) in again]
            found = list({r[:2]: r for r in found}.values())
            again -= {r[:2] for r in found}
            if found:
                yield table(found)

    part = F.floor(F.pmod(F.xxhash64(*[k for k in KEYS if k in wanted.columns]), F.lit(slots)) * parts / slots).cast("int")
    dealt = wanted.repartitionById(parts, part)
    called = (later(dealt).select(*KEYS, "prompt") if later else dealt).mapInArrow(run, REPLIES)
    return called if before is None else called.unionByName(before.join(jobs.select(*KEYS), KEYS, "left_semi"))
