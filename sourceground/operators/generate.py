"""Questions made without a model, and the jobs for a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lookups import CORPUS_VERSION, DETERMINISTIC, SOURCE_ID, SOURCE_NAME, TASKS

# The questions of the deterministic tasks.
QUESTION_T1 = "請為下列無標點古文片段恢復句讀（標點）。"
QUESTION_T6 = "請從以下古籍方劑條文中解析方名、組成與劑量。"

ANSWER = "struct<formula_name:string,indication:string,ingredients:array<struct<herb:string,dose:string,preparation:string,evidence:string>>,manufacturing_method:string,administration:string,contraindication:string>"
DISTRACTORS = "array<struct<option:string,exclusion_reason:string,requires_external:boolean>>"
ITEM_COLUMNS = [
    "item_id", "task", "task_code", "question", "context", "answer_text", "answer_formula", "answer_json", "evidence", "book_id", "passage_id", "inference_level",
    "difficulty", "options", "distractors", "safety_note", "quality_warning", "generator", "review_status", "source_id", "formula_no",
]


def evidence(spans: Column, version: str = CORPUS_VERSION) -> Column:
    return F.struct(
        "book_title_trad",
        X.evidence_chapter(F.col("heading_path"), F.col("chapter")).alias("chapter"),
        "base_text",
        F.lit(SOURCE_ID).alias("source_id"),
        F.lit(SOURCE_NAME).alias("source"),
        F.lit(version).alias("version_commit"),
        spans.alias("spans"),
    )


def _item(code: str, rows: DataFrame, carry: list[str], **given: Column) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    defaults = {
        "task": F.lit(TASKS[code][1]), "task_code": F.lit(code), "answer_text": null("string"), "answer_formula": null(ANSWER), "answer_json": null("string"),
        "book_id": F.col("book_id"), "passage_id": F.col("passage_id"), "inference_level": F.lit("direct"), "difficulty": F.lit("Medium"),
        "options": F.array().cast("array<string>"), "distractors": F.array().cast(DISTRACTORS), "safety_note": F.lit(""), "quality_warning": F.lit(""),
        "generator": F.lit("deterministic"), "review_status": F.lit("unreviewed"), "source_id": F.lit(SOURCE_ID), "formula_no": F.lit(0),
    }
    values = defaults | given
    return rows.select(*[values[c].alias(c) for c in ITEM_COLUMNS], *carry)


def generate_t1(corpus: DataFrame, min_chars: int = 20, max_chars: int = 220, carry: tuple[str, ...] = ()) -> DataFrame:
    """Punctuation restoration: passages of the right length that have any punctuation. ``carry`` keeps columns."""
    text = F.col("raw_text_trad")
    rows = corpus.where(F.length(text).between(min_chars, max_chars) & X.has_punctuation(text))
    return _item(
        "T1", rows, list(carry),
        item_id=X.item_id(F.col("book_id"), F.lit("T1"), F.col("passage_id"), F.lit("")),
        question=F.lit(QUESTION_T1), context=X.remove_punctuation(text), answer_text=text, evidence=evidence(F.array(text)),
    )


def generate_t6(corpus: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Formula structure: an item for each named formula with ingredients; its place in the passage salts the id."""
    rows = corpus.select("*", F.posexplode("formulas").alias("__no", "__f")).where((F.col("__f.formula_name") != "") & (F.size("__f.ingredients") > 0))
    def whole(i: Column) -> Column:
        said = F.concat(i["herb"], F.coalesce(i["dose"], F.lit("")), F.coalesce(i["preparation"], F.lit("")))
        return F.struct(i["herb"].alias("herb"), i["dose"].alias("dose"), i["preparation"].alias("preparation"), said.alias("evidence"))

    null = F.lit(None).cast("string")
    answer = F.struct(
        F.col("__f.formula_name").alias("formula_name"), null.alias("indication"), F.transform("__f.ingredients", whole).alias("ingredients"),
        null.alias("manufacturing_method"), null.alias("administration"), null.alias("contraindication"),
    )
    return _item(
        "T6", rows, list(carry),
        item_id=X.item_id(F.col("book_id"), F.lit("T6"), F.col("passage_id"), F.col("__no").cast("string")),
        question=F.lit(QUESTION_T6), context=F.coalesce(F.nullif(F.col("__f.text"), F.lit("")), F.col("raw_text_trad")),
        answer_formula=answer, evidence=evidence(F.col("__f.ingredients.herb")), safety_note=X.safety_note(F.coalesce(F.col("__f.text"), F.lit(""))), formula_no=F.col("__no"),
    )


def generate_items(corpus: DataFrame, tasks: list[str], model_items: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Items of all requested tasks that the passages can serve, with ``task_rank`` for their order (model tasks by name)."""
    def serves(task: str) -> DataFrame:
        return corpus.where(F.array_contains("candidate_tasks", task)) if task in tasks else corpus.limit(0)

    rank = F.when(F.col("task_code") == "T1", 0).when(F.col("task_code") == "T6", 1).otherwise(2)
    items = generate_t1(serves("T1"), carry=carry).unionByName(generate_t6(serves("T6"), carry=carry))
    if model_items is not None:
        items = items.unionByName(model_items.where(F.col("task_code").isin(*[t for t in tasks if t not in DETERMINISTIC])), allowMissingColumns=True)
    return items.withColumn("task_rank", rank)


def model_jobs(corpus: DataFrame, tasks: list[str], done: DataFrame | None = None) -> DataFrame:
    """Passages times the tasks that need a model, without those already done (passage_id, task_code)."""
    from .corpus import routed_tasks

    jobs = routed_tasks(corpus, [t for t in tasks if t not in DETERMINISTIC])
    return resume(jobs, done) if done is not None else jobs


def resume(jobs: DataFrame, done: DataFrame) -> DataFrame:
    return jobs.join(done.select("passage_id", "task_code").distinct(), ["passage_id", "task_code"], "left_anti")


def answer_scan_text(items: DataFrame | None = None) -> Column:
    """All texts of an answer, joined for the herb scan: text, JSON reply, or the fields of a formula."""
    f = F.col("answer_formula")
    parts = F.flatten(F.transform(f["ingredients"], lambda i: F.array(i["herb"], i["dose"], i["preparation"], i["evidence"])))
    formula = F.concat_ws(" ", f["formula_name"], f["indication"], F.array_join(parts, " "), f["manufacturing_method"], f["administration"], f["contraindication"])
    return F.coalesce(F.col("answer_text"), F.when(f.isNotNull(), formula), F.col("answer_json"), F.lit(""))
