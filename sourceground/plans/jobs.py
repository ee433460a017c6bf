"""Whole jobs: release build, simple mode, model run with resume."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lookups import DETERMINISTIC
from ..operators import corpus as C
from ..operators import generate, model, report, sampling, validate
from ..operators.calls import KEYS, REPLIES
from ..sources.books import catalog
from ..operators.sampling import LETTERS
from ..sources.scratch import delete, exists, scratch_path, stored

ORDER = ["pilot_ord", "book_ord", "passage_idx", "task_rank", "formula_no"]
#: Bytes up to which a table of known size is sent to all executors.
SENT = 64 << 20
CARRY = ("pilot", "pilot_ord", "book_ord", "passage_idx")
#: What tells a passage of the lists apart.
PLACE = ["book_id", "pilot_ord", "book_ord", "passage_idx"]
#: Tasks of a release: those whose items need no model.
TASKS = ["T1", "T6"]


def pilot_corpus(files: DataFrame, pilots: DataFrame, date: str, min_chars: int = 12) -> DataFrame:
    """Corpus records of the listed books. Files are pruned before anything is exploded; one scan serves all lists."""
    return C.ingest(C.listed(files, pilots), date, min_chars, pilots=pilots)


def release(files: DataFrame, pilots: DataFrame, date: str, per_book: int = 30, cap: int = 25, full: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of a release.

    Every passage is counted and every item checked, but only thin rows of them are stored: they decide what is
    released. ``corpus`` and ``items`` are plans that make whole rows of the released passages alone, so
    ``full`` need not be stored.
    """
    full = full if full is not None else pilot_corpus(files, pilots, date)
    passages = stored(full.select("book_id", *CARRY, F.col("formulas.formula_name").alias("formulas")), "counted")
    checked = stored(validate.generate_and_validate(full, TASKS, carry=CARRY).select("book_id", *CARRY, "task_code", "task_rank", "formula_no", "ok"), "checked")
    released = stored(sampling.first_of_each(checked.where("ok"), cap, ORDER), "released")
    first = stored(sampling.balanced_sample(passages, per_book), "first")
    sample = stored(sampling.release_corpus(passages, first, released, ("book_id", "passage_idx")), "sample")
    stats = report.pilot_stats(passages, sample, checked, released)
    return {
        "catalog": catalog(files), "corpus": full.join(sample.select(*PLACE), PLACE, "left_semi").select(*full.columns), "items": whole_items(full, released), "stats": stats,
        "document": report.stats_document(stats, report.task_map(checked, "pilot")), "totals": report.totals(stats),
    }


def whole_items(full: DataFrame, thin: DataFrame) -> DataFrame:
    """The checked items that ``thin`` names, sorted by task, book and id; only their passages are made into items."""
    some = full.join(thin.select(*PLACE), PLACE, "left_semi").select(*full.columns)
    checked, key = validate.generate_and_validate(some, TASKS, carry=CARRY), ["book_id", *ORDER]
    return checked.join(thin.select(*key), key, "left_semi").select(*checked.columns).orderBy("task_code", "book_id", "item_id")


def simple(full: DataFrame, n: int, seed: int = 0, tasks: tuple[str, ...] = ("T1", "T6")) -> DataFrame:
    """A balanced, validated set of ``n`` items in a seeded order. ``full`` has min_chars 20.

    It is stored once. Thin rows of its valid items decide what is taken; only the passages of
    these at most ``n`` items are made into whole items.
    """
    order = ["shuffle", "passage_id", "task_rank", "formula_no"]
    keyed = stored(full.withColumn("shuffle", sampling.shuffle_key(seed, F.col("passage_id"))), "corpus")
    checked = validate.generate_and_validate(keyed, list(tasks), carry=("shuffle",))
    thin = stored(checked.where("ok").select("task_code", "book_id", *order), "thin")
    taken = sampling.balanced_take(thin, n, order).select("passage_id", "task_rank", "formula_no")
    taken = stored(taken.withColumn("__place", F.monotonically_increasing_id()), "taken")  # n rows at most, sorted
    sent = F.broadcast(taken) if n * 200 <= SENT else taken
    some = keyed.join(sent.select("passage_id"), "passage_id", "left_semi")
    return validate.generate_and_validate(some, list(tasks), carry=("shuffle",)).join(sent, ["passage_id", "task_rank", "formula_no"]).orderBy("__place").drop("__place")


def judged(full: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """Replies as checked items on their passages."""
    rows = full.withColumns({"source_text": F.col("raw_text_trad"), "source_normalized": F.col("normalized_text")})
    items = model.items_from_replies(replies, rows, name, carry=("source_text", "source_normalized"))
    return validate.validate(items).drop("source_text", "source_normalized")


def keyed_jobs(full: DataFrame, tasks: list[str], done: DataFrame | None, seed: int) -> DataFrame:
    """Model jobs that are not done, each with the seeded key that orders them."""
    jobs = generate.model_jobs(full, tasks, done)
    return jobs.withColumn("shuffle", sampling.shuffle_key(seed, F.concat_ws("|", "passage_id", "task_code")))


JOB_ORDER = ["shuffle", "passage_id", "task_code"]
#: What a job's prompt and the check of its answer need of its passage, and the columns of a job in a run.
TOLD = ["passage_id", "book_id", *model.SEEN, "heading_path", "normalized_text"]
ROW = [*JOB_ORDER, "tried", *TOLD[1:]]
#: A block of further jobs serves so many waves, or is that part of all jobs, if this is more; jobs in one of its files.
WAVES, BLOCKS, SLICE = 4, 8, 1 << 17


def _range(low: Row | None, high: Row | None, key: Callable[[str], Column] = F.col) -> Column:
    """Is a job's key after ``low`` and not after ``high``, rows of ``JOB_ORDER`` (None: no bound)?"""
    whole = F.struct(*[key(c).alias(c) for c in JOB_ORDER])
    at = lambda row: F.struct(*[F.lit(row[c]).alias(c) for c in JOB_ORDER])
    found = F.lit(True)
    if low is not None:  # the first column alone is what a file's statistics tell
        found = found & (key("shuffle") >= low["shuffle"]) & (whole > at(low))
    return found if high is None else found & (key("shuffle") <= high["shuffle"]) & (whole <= at(high))


def prompted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("prompt", model.build_prompt(F.col("task_code")))


def passages_in_range(full: DataFrame, tasks: list[str], seed: int, low: Row | None, high: Row | None) -> DataFrame:
    """Passages with ``__tasks``: the tasks of those jobs whose keys lie in a range, if there are any."""
    wanted = F.array(*[F.lit(t) for t in tasks if t not in DETERMINISTIC]).cast("array<string>")
    key = lambda t: F.struct(sampling.shuffle_key(seed, F.concat_ws("|", "passage_id", t)).alias("shuffle"), F.col("passage_id"), t.alias("task_code"))
    kept = F.filter(F.transform(F.array_intersect("candidate_tasks", wanted), key), lambda k: _range(low, high, lambda c: k[c]))
    return full.select("passage_id", *model.SEEN, F.transform(kept, lambda k: k["task_code"]).alias("__tasks")).where(F.size("__tasks") > 0)


def union(tables: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def next_size(target: int, accepted: int, tried: int, floor: int, ceiling: int) -> int:
    """Jobs for the next wave: what is missing, divided by the share of jobs accepted so far (one of two before any)."""
    missing = target - accepted
    return max(0 if missing <= 0 else floor, min(ceiling, -(-missing * (tried + 2) // (accepted + 1))))


class ModelRun:
    """A model run whose state is in ``folder``: ``wave-00001/replies``, ``/items`` and ``/ledger``, and so on.

    A wave counts once its items are written. A run that is started again on the same folder
    goes on with the wave that was not; its ledger keeps the replies that were paid for.
    """

    def __init__(self, full: DataFrame, tasks: list[str], client: Callable[..., str], name: str, folder: str, slots: int, window: int = 8, tries: int = 3, seed: int = 0, done: DataFrame | None = None, **options):
        self.full, self.tasks, self.client, self.name, self.folder = full, tasks, client, name, folder.rstrip("/")
        self.slots, self.window, self.tries, self.seed, self.given, self.options = slots, window, tries, seed, done, options
        self.spark = full.sparkSession
        self._bars: list[int] | None = None  # not opened

    def _wave(self, number: int, table: str) -> str:
        return f"{self.folder}/wave-{number:05d}/{table}"

    def waves(self) -> int:
        """Waves whose items are written."""
        n = 0
        while exists(self.spark, f"{self._wave(n + 1, 'items')}/_SUCCESS"):
            n += 1
        return n

    def _read(self, table: str) -> DataFrame | None:
        n = self.waves()
        return self.spark.read.parquet(*[self._wave(k, table) for k in range(1, n + 1)]) if n else None

    def replies(self) -> DataFrame | None:
        """Every reply and error of every wave, with ``wave``."""
        return self._read("replies")

    def items(self) -> DataFrame | None:
        """The checked items of all waves, with ``wave`` and the key that orders them."""
        return self._read("items")

    def counts(self) -> tuple[int, int]:
        """(accepted items, jobs called) of the waves so far."""
        items, replies = self.items(), self.replies()
        return (items.where("ok").count(), replies.count()) if items is not None else (0, 0)

    def _open(self) -> None:
        """What the folder's waves leave to do: ``_retry`` holds the jobs to be tried again, ``_bars`` counts those never called by the first letters of their keys.

        Jobs given as done, answered with JSON or tried ``tries`` times are taken by no wave again.
        """
        found, given = self.replies(), self.given.select(*KEYS) if self.given is not None else None
        called, self._retry, self._retry_path = given, None, None
        if found is not None:
            tried = found.groupBy(*KEYS).agg(F.max(X.json_object(F.col("reply")).isNotNull()).alias("parsed"), F.count(F.lit(1)).cast("int").alias("tried"))
            called = tried.select(*KEYS) if given is None else tried.select(*KEYS).union(given)
            again = tried.where(~F.col("parsed") & (F.col("tried") < self.tries)).select(*KEYS, "tried")
            again = again if given is None else again.join(given.distinct(), KEYS, "left_anti")
            self._keep_retry(keyed_jobs(self.full, self.tasks, None, self.seed).join(again, KEYS).select(*ROW))
        self._called = stored(called.withColumn("shuffle", self._key()), "called") if called is not None else None
        thin = keyed_jobs(self.full.select("passage_id", "candidate_tasks"), self.tasks, self._called, self.seed)
        self._bars = [0] * 16**LETTERS
        for bar, rows in thin.groupBy(F.substring("shuffle", 1, LETTERS).alias("bar")).count().collect():  # a row for each bar
            self._bars[int(bar, 16)] = rows
        self._at, self._block, self._block_path, self._end = None, None, None, 0

    def _key(self) -> Column:
        return sampling.shuffle_key(self.seed, F.concat_ws("|", "passage_id", "task_code"))

    def _keep_retry(self, rows: DataFrame) -> None:
        path, old = scratch_path(self.spark, "retry"), self._retry_path
        self._retry, self._retry_path = stored(rows, "retry", path), path
        if old:
            delete(self.spark, old)

    def _fresh(self, size: int) -> DataFrame:
        """Jobs never called, of which at least ``size`` have the next keys, if there are so many.

        They are read from a stored block of further jobs, which serves several waves: the corpus is read
        a bounded number of times (``BLOCKS``), however many waves there are.
        """
        first = int(self._at["shuffle"][:LETTERS], 16) + 1 if self._at else 0  # of the last key's bar some are left
        if sum(self._bars[first : self._end]) < size and self._end < len(self._bars):
            wanted, held, self._end = max(WAVES * size, -(-sum(self._bars) // BLOCKS)), 0, first
            while self._end < len(self._bars) and held < wanted:
                held += self._bars[self._end]
                self._end += 1
            high = {"shuffle": f"{self._end - 1:0{LETTERS}x}" + "g", "passage_id": "", "task_code": ""}  # after all keys of its last bar
            jobs = keyed_jobs(self.full.select(*TOLD, "candidate_tasks"), self.tasks, None, self.seed).where(_range(self._at, high))
            if self._called is not None:
                jobs = jobs.join(self._called.where(_range(self._at, high)).select(*KEYS).distinct(), KEYS, "left_anti")
            low = max(0, first - 1)
            slices = -(-(held + 1) // SLICE)  # a file for each range of keys, so that a wave reads its own
            place = (F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / 16 ** (8 - LETTERS) - low) * slices / (self._end - low)
            rows = jobs.withColumn("tried", F.lit(0)).select(*ROW).repartitionById(slices, F.least(F.floor(place).cast("int"), F.lit(slices - 1)))
            path, old = scratch_path(self.spark, "block"), self._block_path
            self._block, self._block_path = stored(rows, "block", path), path
            if old:
                delete(self.spark, old)
        return self._block.where(_range(self._at, None)) if self._block is not None else None

    def step(self, size: int) -> int:
        """Runs the next wave with ``size`` jobs; returns the jobs called."""
        if self._bars is None:
            self._open()
        number = self.waves() + 1
        fresh = self._fresh(size)
        open_ = [df for df in (self._retry, fresh) if df is not None]
        if not open_ or size < 1:
            rows, last = keyed_jobs(self.full.limit(0), self.tasks, None, self.seed).withColumn("tried", F.lit(0)).select(*ROW), self._at
        else:
            rows = union(open_)
            last = sampling.border(rows.select(*JOB_ORDER), JOB_ORDER, size)
            rows = rows.where(_range(None, last))
        path = scratch_path(self.spark, "wave")
        rows = stored(rows, "wave", path)
        replies = model.complete(rows, self.client, self.slots, self.window, ledger=self._wave(number, "ledger"), later=prompted, **self.options)
        replies.withColumn("wave", F.lit(number)).write.mode("overwrite").parquet(self._wave(number, "replies"))
        kept = self.spark.read.parquet(self._wave(number, "replies"))
        called = kept.count()
        items = judged(rows, kept, self.name).withColumns({"wave": F.lit(number), "shuffle": self._key()})
        items.write.mode("overwrite").parquet(self._wave(number, "items"))
        failed = kept.where(X.json_object(F.col("reply")).isNull()).select(*KEYS)
        again = rows.where(F.col("tried") + 1 < self.tries).join(failed, KEYS, "left_semi").withColumn("tried", F.col("tried") + 1).select(*ROW)
        left = self._retry.where(_range(last, None)) if self._retry is not None and last is not None else None
        self._keep_retry(again if left is None else again.unionByName(left))
        delete(self.spark, path)
        if last is None:
            last = {"shuffle": f"{max(self._end, 1) - 1:0{LETTERS}x}" + "g", "passage_id": "", "task_code": ""}
        self._at = last if self._at is None else max(self._at, last, key=lambda row: [row[c] for c in JOB_ORDER])
        return called

    def run(self, target: int, floor: int = 64, ceiling: int = 1_000_000) -> DataFrame:
        """Waves until ``target`` items are accepted, those given as done included, or no job is left.

        Returns the accepted items of this run's waves in the order of waves and keys, and of the
        last wave only what the target lacks. The next wave's size follows from the share
        accepted so far. Items given as done are counted, not returned.
        """
        already = self.given.select(*KEYS).distinct().count() if self.given is not None else 0
        accepted, tried = self.counts()
        while size := next_size(target - already, accepted, tried, floor, ceiling):
            called = self.step(size)
            if not called:
                break
            tried += called
            accepted += self.spark.read.parquet(self._wave(self.waves(), "items")).where("ok").count()
        last = self.waves()
        items = self.items()
        if items is None:
            return judged(self.full, self.spark.createDataFrame([], REPLIES), self.name).where("ok")
        ok = items.where("ok")
        earlier = ok.where(F.col("wave") < last)
        rest = sampling.first_n(ok.where(F.col("wave") == last), JOB_ORDER, target - already, earlier.count())
        return earlier.unionByName(rest)


def model_waves(full: DataFrame, tasks: list[str], client: Callable[..., str], name: str, waves: int, slots: int, seed: int = 0, store: Callable[[DataFrame], DataFrame] = lambda df: df, **options) -> list[tuple[DataFrame, DataFrame]]:
    """Every job once, in ``waves`` waves of equal size: (stored replies, checked items) of each wave. For targets, retries and restarts see ``ModelRun``.

    ``store`` must write the replies unless ``options`` name a ledger. A wave is a range of keys,
    which each passage tells of its own tasks; so no keys are stored or joined, and of a wave
    a passage moves once, without prompts.
    """
    thin = keyed_jobs(full.select("passage_id", "candidate_tasks"), tasks, None, seed).select(*JOB_ORDER)
    total = thin.count()
    size = max(1, -(-total // waves))
    low, found = None, []
    for k in range(1, waves + 1):
        high = sampling.border(thin, JOB_ORDER, k * size) if k * size < total else None
        wave = passages_in_range(full, tasks, seed, low, high)
        wave = wave if (k - 1) * size < total else wave.limit(0)
        later = lambda dealt: prompted(dealt.withColumn("task_code", F.explode("__tasks")))
        replies = store(model.complete(wave, client, slots, 1, later=later, **options))
        found.append((replies, judged(full, replies, name)))
        low = high
    return found
