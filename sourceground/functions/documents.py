"""Schema documents of corpus records and items."""

from __future__ import annotations

from .lookups import DIFFICULTIES, INFERENCE_LEVELS, PUNCTUATION_STATES, REVIEW_STATES, SOURCE_ID, TASKS, TIERS

TEXT = {"type": "string"}
MAYBE = {"type": ["string", "null"]}


def _list(items: dict) -> dict:
    return {"type": "array", "items": items}


def _object(required: tuple[str, ...] = (), **properties: dict) -> dict:
    return {"type": "object", "required": list(required), "properties": properties}


# Fields, types and required fields of the two row types.
INGREDIENT = _object(herb=TEXT, dose=MAYBE, preparation=MAYBE)
CORPUS_RECORD = _object(
    ("passage_id", "book_id", "book_title_trad", "book_title_simp", "category_level_1", "raw_text_trad", "raw_text_simp", "normalized_text", "source_id", "version_commit"),
    passage_id=TEXT, book_id=TEXT, book_title_trad=TEXT, book_title_simp=TEXT, author=MAYBE, dynasty=MAYBE, year=MAYBE, category_level_1=TEXT, category_level_2=TEXT,
    base_text=MAYBE, quality_score_source=MAYBE, quality_tier={"enum": list(TIERS)}, heading_path=_list(TEXT), chapter=MAYBE, section_title=MAYBE,
    raw_text_trad=TEXT, raw_text_simp=TEXT, normalized_text=TEXT, formulas=_list(_object(formula_name=MAYBE, ingredients=_list(INGREDIENT), text=TEXT)),
    candidate_tasks=_list(TEXT), punctuation_status={"enum": list(PUNCTUATION_STATES)}, source_id={"const": SOURCE_ID}, source_url=MAYBE, source_license=TEXT, version_commit=TEXT, ingestion_date=MAYBE,
)
ITEM = _object(
    ("item_id", "task", "task_code", "question", "answer", "evidence", "book_id", "passage_id", "inference_level", "source_id"),
    item_id=TEXT, task=TEXT, task_code={"enum": list(TASKS)}, question=TEXT, context=TEXT, answer={},
    evidence=_object(("book_title_trad", "source_id"), book_title_trad=TEXT, chapter=MAYBE, base_text=MAYBE, source_id={"const": SOURCE_ID}, source=TEXT, version_commit=TEXT, spans=_list(TEXT)),
    book_id=TEXT, passage_id=TEXT, inference_level={"enum": list(INFERENCE_LEVELS)}, difficulty={"enum": list(DIFFICULTIES)}, options=_list(TEXT),
    distractors=_list(_object(option=TEXT, exclusion_reason=TEXT, requires_external={"type": "boolean"})),
    safety_note=TEXT, quality_warning=TEXT, generator=TEXT, review_status={"enum": list(REVIEW_STATES)}, source_id={"const": SOURCE_ID},
)
