"""Every claim of an item must occur in its passage.

Rows carry ``source_text`` and ``source_normalized``: from the passage itself while
generating, or joined by passage_id for stored items. Errors are ``code:detail`` strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lookups import SOURCE_ID
from .generate import ANSWER, answer_scan_text

NONE = "array<string>"


def with_source(items: DataFrame, corpus: DataFrame) -> DataFrame:
    """Joins each item with its passage; a missing passage is empty text."""
    source = corpus.select("passage_id", F.col("raw_text_trad").alias("source_text"), F.col("normalized_text").alias("source_normalized"))
    joined = items.join(source, "passage_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("source_text", "source_normalized")})


def _found(needle: Column) -> Column:
    return X.contains(F.col("source_text"), F.col("source_normalized"), needle)


def _if(condition: Column, error: str | Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.array(error if isinstance(error, Column) else F.lit(error))).otherwise(F.array().cast(NONE))


def provenance_errors() -> Column:
    title, source = F.col("evidence.book_title_trad"), F.col("evidence.source_id")
    return F.concat(_if(title.isNull() | (title == ""), "title_missing"), _if(source.isNull() | (source != SOURCE_ID), "source_id"))


def span_errors() -> Column:
    missing = F.filter(F.col("evidence.spans"), lambda s: ~_found(s))
    return F.coalesce(F.transform(missing, lambda s: F.concat(F.lit("span:"), F.substring(F.coalesce(s, F.lit("")), 1, 24))), F.array().cast(NONE))


def level_errors() -> Column:
    return _if(F.col("inference_level") == "external_required", "external_required")


def formula_errors() -> Column:
    """Name, herbs and doses of a formula must occur in the passage, whoever made it: a model's answer is read from its JSON object."""
    said = F.when(F.col("answer_json").startswith("{"), F.from_json("answer_json", ANSWER))
    return X.let(F.coalesce("answer_formula", said), _formula_errors)


def _formula_errors(f: Column) -> Column:
    name = _if((f["formula_name"] != "") & ~_found(f["formula_name"]), F.concat(F.lit("name:"), f["formula_name"]))

    def of(i: Column) -> Column:
        bad = lambda c: c.isNotNull() & (c != "") & ~_found(c)
        return F.array_compact(F.array(F.when(bad(i["herb"]), F.concat(F.lit("herb:"), i["herb"])), F.when(bad(i["dose"]), F.concat(F.lit("dose:"), i["dose"]))))

    parts = F.coalesce(F.flatten(F.transform(f["ingredients"], of)), F.array().cast(NONE))
    return F.when((F.col("task") == "formula_structure_parsing") & f.isNotNull(), F.concat(name, parts)).otherwise(F.array().cast(NONE))


def punctuation_errors() -> Column:
    answer = F.col("answer_text")
    # Removing marks twice is removing them once, so a context that is the bare answer needs no second pass.
    changed = X.let(F.coalesce("context", F.lit("")), lambda c: (X.remove_punctuation(answer) != c) & (X.remove_punctuation(answer) != X.remove_punctuation(c)))
    errors = F.when(answer.isNull(), F.array(F.lit("answer_not_text"))).otherwise(_if(changed, "punctuation_changes_text"))
    return F.when(F.col("task") == "punctuation_restoration", errors).otherwise(F.array().cast(NONE))


def _distractor_errors() -> Column:
    bare = F.filter("distractors", lambda d: F.coalesce(d["exclusion_reason"], F.lit("")) == "")
    return F.coalesce(F.transform(bare, lambda d: F.lit("distractor_without_reason")), F.array().cast(NONE))


def _distractor_warnings() -> Column:
    outside = F.filter("distractors", lambda d: (F.coalesce(d["exclusion_reason"], F.lit("")) != "") & F.coalesce(d["requires_external"], F.lit(False)))
    return F.coalesce(F.transform(outside, lambda d: F.lit("distractor_needs_outside_knowledge")), F.array().cast(NONE))


def _has_options() -> Column:
    return F.coalesce(F.size("options"), F.lit(0)) > 0


def _answered() -> Column:
    """Is there an answer? Empty texts, lists and objects, null, zero and false are none."""
    json = F.trim(F.coalesce("answer_json", F.lit("")))
    empty = json.isin("", '""', "[]", "{}", "null", "false") | F.coalesce(json.try_cast("double") == 0, F.lit(False))
    return (F.coalesce("answer_text", F.lit("")) != "") | F.col("answer_formula").isNotNull() | ~empty


def mcq_errors() -> Column:
    answered = _answered()
    few = _if(F.size("options") < 3, F.concat(F.lit("few_options:"), F.size("options").cast("string")))
    return F.when(_has_options(), F.concat(few, _if(~answered, "mcq_without_answer"), _distractor_errors())).otherwise(F.array().cast(NONE))


def mcq_warnings() -> Column:
    return F.when(_has_options(), _distractor_warnings()).otherwise(F.array().cast(NONE))


def safety_warnings() -> Column:
    said = F.concat(F.coalesce("context", F.lit("")), answer_scan_text(), F.coalesce(F.array_join("options", " "), F.lit("")))
    return _if(X.mentions_restricted_herb(said) & (F.coalesce("safety_note", F.lit("")) == ""), "safety_note_missing")


def validate(items: DataFrame) -> DataFrame:
    """Adds ``errors``, ``warnings`` and ``ok``; no row is lost and none fails the batch."""
    errors = F.concat(provenance_errors(), span_errors(), level_errors(), formula_errors(), punctuation_errors(), mcq_errors())
    return items.withColumns({"errors": errors, "warnings": F.concat(mcq_warnings(), safety_warnings())}).withColumn("ok", F.size("errors") == 0)


def validate_mcq(items: DataFrame) -> DataFrame:
    """As ``validate``, with the distractors checked even without options (and twice with them)."""
    checked = validate(items)
    checked = checked.withColumns({"errors": F.concat("errors", _distractor_errors()), "warnings": F.concat("warnings", _distractor_warnings())})
    return checked.withColumn("ok", F.size("errors") == 0)


def validate_stored(items: DataFrame, corpus: DataFrame) -> DataFrame:
    return validate(with_source(items, corpus)).drop("source_text", "source_normalized")


def generate_and_validate(corpus: DataFrame, tasks: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Deterministic items, checked against the passage that rides along: no join."""
    from .generate import generate_items

    rows = corpus.withColumns({"source_text": F.col("raw_text_trad"), "source_normalized": F.col("normalized_text")})
    return validate(generate_items(rows, tasks, carry=("source_text", "source_normalized", *carry))).drop("source_text", "source_normalized")
