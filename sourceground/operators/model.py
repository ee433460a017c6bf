"""Prompts, calls of a user's model client, replies to items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lookups import MCQ_TASKS, SAFETY_NOTE, SOURCE_NAME, TASKS
from . import calls
from .generate import DISTRACTORS, ITEM_COLUMNS, _item

SYSTEM = "Work only from the passage given. Quote evidence word for word. Answer with one JSON object."
DIFFICULTY = {
    "Medium": "Ask for one fact or one plain step.",
    "Hard": "Ask for two or more steps that the passage supports.",
    "Expert": "Ask for a fine distinction that the passage alone decides.",
}
FORM_OPEN = 'Give {"question","answer","evidence_spans","inference_level","difficulty","safety_note"}.'
FORM_CHOICE = 'Give four options: {"question","options","answer","distractors":[{"option","exclusion_reason","requires_external"}],"evidence_spans","inference_level","difficulty","safety_note"}.'


#: What a model may see of a passage.
SEEN = ("book_title_trad", "author", "dynasty", "year", "base_text", "quality_score_source", "chapter", "section_title", "raw_text_trad")


def meta_block(columns: tuple[str, ...] = SEEN) -> Column:
    """The fields a model may see, as JSON with nulls."""
    return F.to_json(F.struct(F.lit(SOURCE_NAME).alias("source"), *columns), {"ignoreNullFields": "false"})


def build_prompt(task: Column, difficulty: str = "Hard") -> Column:
    """The prompt of a row for its task (or ``router``); null for an unknown task.

    T2, T6 and the router have forms of their own, which difficulty does not touch; five
    tasks ask for options, the others for an open answer.
    """
    meta = meta_block()
    level = DIFFICULTY.get(difficulty, DIFFICULTY["Hard"])
    listing = "; ".join(f"{code} {en}" for code, (_, en) in TASKS.items())
    prompt = F.when(task == "router", F.concat(F.lit(f"Which of these tasks can the passage serve? {listing}\n"), meta))
    prompt = prompt.when(task == "T2", F.concat(F.lit("Translate the passage into the modern language, sentence by sentence.\n"), meta))
    raw = F.concat_ws("\n", F.lit("List name, ingredients, doses and preparation of the formula, verbatim."), F.coalesce("book_title_trad", F.lit("")), F.coalesce("chapter", F.lit("")), F.col("raw_text_trad"))
    prompt = prompt.when(task == "T6", raw)
    for code, (zh, en) in TASKS.items():
        if code not in ("T2", "T6"):
            form = FORM_CHOICE if code in MCQ_TASKS else FORM_OPEN
            prompt = prompt.when(task == code, F.concat(F.lit(f"{zh} ({en}), difficulty {difficulty}. {level}\n{form}\n"), meta))
    return prompt


def complete(jobs: DataFrame, client: Callable[..., str], tasks: int, window: int = 1, system: str = SYSTEM, **options) -> DataFrame:
    """``calls.complete`` with the library's system text; ``tasks * window`` calls are in flight at most."""
    return calls.complete(jobs, client, tasks, window, system=system, **options)


def job_accounting(replies: DataFrame) -> DataFrame:
    """One row: jobs_total = errored + parse_failed + yielded."""
    parsed = X.json_object(F.col("reply")).isNotNull()
    failed = F.col("error").isNotNull()
    return replies.agg(
        F.count(F.lit(1)).alias("jobs_total"),
        F.count_if(failed).alias("errored"),
        F.count_if(~failed & ~parsed).alias("parse_failed"),
        F.count_if(~failed & parsed).alias("yielded"),
    )


TEXTS = ("question", "answer", "context", "task", "evidence", "evidence_spans", "inference_level", "difficulty", "safety_note", "quality_warning")
LISTS = ("evidence", "evidence_spans", "options")


def _taken_apart(data: Column) -> Column:
    """struct(texts, lists, distractors, answer) of a reply's fields, each read once.

    As one value (``let``) it stays out of the code that Spark generates for the join, which with all
    these fields is one method too long for the JVM to compile.
    """

    def parts(fields: Column) -> Column:
        get = lambda n, kind: F.try_variant_get(F.try_element_at(fields, F.lit(n)), "$", kind)
        texts = F.struct(*[get(n, "string").alias(n) for n in TEXTS])
        lists = F.struct(*[get(n, "array<string>").alias(n) for n in LISTS])
        return F.struct(texts.alias("texts"), lists.alias("lists"), get("distractors", DISTRACTORS).alias("distractors"), F.try_element_at(fields, F.lit("answer")).alias("answer"))

    return X.let(F.try_variant_get(data, "$", "map<string,variant>"), parts)


def _get(name: str) -> Column:
    return F.col(f"__said.texts.{name}")


def items_from_replies(replies: DataFrame, corpus: DataFrame, model: str, difficulty: str = "Hard", carry: tuple[str, ...] = ()) -> DataFrame:
    """Replies (passage_id, task_code, reply) that hold JSON, as items on their passages, or on rows of ``corpus`` that are their jobs (with ``task_code``)."""
    data = replies.select("passage_id", "task_code", X.json_object(F.col("reply")).alias("__data")).where("__data is not null")
    rows = corpus.join(data, [c for c in calls.KEYS if c in corpus.columns]).withColumn("__said", _taken_apart(F.col("__data")))
    filled = lambda c: F.when(c != "", c)
    listed = lambda n: F.coalesce(F.col(f"__said.lists.{n}"), F.when(filled(_get(n)).isNotNull(), F.array(_get(n))))
    some = lambda c: F.when(F.size(c) > 0, c)
    spans = F.coalesce(some(listed("evidence")), some(listed("evidence_spans")), F.array().cast("array<string>"))
    options = F.coalesce("__said.lists.options", F.array().cast("array<string>"))
    answer = F.col("__said.answer")
    is_text = F.coalesce(F.schema_of_variant(answer) == "STRING", F.lit(False))
    # A text stands in answer_text alone; an answer that is there and null stands nowhere; without any, the whole reply is the answer.
    answer_json = F.when(answer.isNull(), F.to_json("__data")).when(~is_text & ~F.is_variant_null(answer), F.to_json(answer))
    said = F.concat(F.coalesce(_get("context"), F.lit("")), F.coalesce(_get("answer"), answer_json, F.lit("")), F.array_join(options, " "))
    note = F.coalesce(_get("safety_note"), F.lit(""))
    names = F.create_map(*[F.lit(x) for code, (_, en) in TASKS.items() for x in (code, en)])
    from .generate import evidence

    return _item(
        "T2", rows, list(carry),
        item_id=X.item_id(F.col("book_id"), F.col("task_code"), F.col("passage_id"), F.lit(model)),
        task=F.coalesce(filled(_get("task")), F.try_element_at(names, F.col("task_code")), F.col("task_code")), task_code=F.col("task_code"),
        question=F.coalesce(_get("question"), F.lit("")), context=F.coalesce(filled(_get("context")), F.col("raw_text_trad")),
        answer_text=F.when(is_text, _get("answer")), answer_json=answer_json, evidence=evidence(spans),
        inference_level=F.coalesce(_get("inference_level"), F.lit("direct")), difficulty=F.coalesce(filled(_get("difficulty")), F.lit(difficulty)),
        options=options, distractors=F.coalesce("__said.distractors", F.array().cast(DISTRACTORS)),
        safety_note=F.when((note == "") & X.mentions_restricted_herb(said), SAFETY_NOTE).otherwise(note),
        quality_warning=F.coalesce(_get("quality_warning"), F.lit("")), generator=F.lit(model),
    )


__all__ = ["ITEM_COLUMNS", "build_prompt", "complete", "items_from_replies", "job_accounting", "meta_block"]
