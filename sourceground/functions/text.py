"""Markup and text as column expressions.

Patterns carry ``(?d)`` where a dot must stop at line feeds only, and white space is one
explicit class, because Java's own classes are ASCII.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookups import PUNCTUATION, SAFETY_HERBS, SAFETY_NOTE, SOURCE_HOMEPAGE

#: White space of Unicode, as a character class body.
WS = r"\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same characters, one by one.
SPACES = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
HAN = r"㐀-鿿"
HEADING = rf"(?d)^(={{3,}})[{WS}]*(.+?)[{WS}]*\1[{WS}]*$"
CROSSREF = r"(?d)\[\[(.*?)\]\]"
FORMULA = rf"(?s)<F>[{WS}]*(.*?)[{WS}]*</F>"
HERB_DOSE = rf"(?d)([{HAN}]+)[{WS}]*<l>[{WS}]*(.*?)[{WS}]*</l>"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once for use in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.trim(text, F.lit(SPACES))


def crossref_label(inner: Column) -> Column:
    """The last part between colons that is neither empty nor ``book`` or ``page``; else empty."""
    parts = F.filter(F.split(inner, ":", -1), lambda p: ~p.isin("", "book", "page"))
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))


def replace_crossrefs(text: Column) -> Column:
    """Each ``[[...]]`` by its label."""

    def put(t):
        labels = F.transform(F.regexp_extract_all(t, F.lit(CROSSREF), F.lit(1)), crossref_label)
        return F.array_join(F.zip_with(F.split(t, CROSSREF, -1), labels, lambda p, label: F.concat(p, F.coalesce(label, F.lit("")))), "")

    return F.when(F.contains(text, F.lit("[[")), let(text, put)).otherwise(text)


def contains_any(text: Column, signs: Iterable[str]) -> Column:
    """Does the text hold any of ``signs``? A byte search for each until one is found, many times faster than a pattern of alternatives."""
    return functools.reduce(Column.__or__, [F.contains(text, F.lit(sign)) for sign in signs])


def _marked(text: Column) -> Column:
    """Is there anything that inline markup starts with?"""
    return contains_any(text, ("<", "((", "[[", "**", "__"))


def strip_inline(text: Column, keep_dose: bool = True) -> Column:
    """Reading text without inline markup; doses stay or go. Only text that has markup meets its patterns."""
    plain = strip(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\t"), F.lit("")))
    return F.when(_marked(text) | F.contains(text, F.lit("　")), _without_markup(text, keep_dose)).otherwise(plain)


def _without_markup(text: Column, keep_dose: bool) -> Column:
    text = F.regexp_replace(text, r"(?s)\(\(.*?\)\)", "")
    text = replace_crossrefs(text)
    text = F.regexp_replace(text, r"(?d)\*\*(.*?)\*\*", "$1")
    text = F.regexp_replace(text, r"(?d)__(.*?)__", "$1")
    text = F.regexp_replace(text, rf"(?d)<l>[{WS}]*(.*?)[{WS}]*</l>", "$1" if keep_dose else "")
    text = F.regexp_replace(text, r"<[#&~]/>", "")
    text = F.regexp_replace(text, rf"</?[A-Za-z][A-Za-z0-9]*[{WS}]*/?>", "")
    text = F.regexp_replace(text, r"[ \t]+", "")
    return strip(F.regexp_replace(text, "　{2,}", "　"))


def normalize(text: Column) -> Column:
    """Key for matching: no markup, doses, marks or space."""
    bare = F.when(_marked(text), strip_inline(text, keep_dose=False)).otherwise(text)
    return F.regexp_replace(bare, r"[^\p{L}\p{N}_㐀-鿿豈-﫿]+", "")


def remove_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def has_punctuation(text: Column) -> Column:
    """Would ``remove_punctuation`` change the text?"""
    return contains_any(text, PUNCTUATION)


def _is_heading(line: Column) -> Column:
    return F.contains(line, F.lit("===")) & strip(line).rlike(HEADING)


def heading_title(line: Column) -> Column:
    """Title of a heading line, null for other lines."""
    return F.when(_is_heading(line), strip_inline(F.regexp_extract(strip(line), HEADING, 2)))


def heading_signs(line: Column) -> Column:
    """Number of equal signs of a heading line, null for other lines."""
    return F.when(_is_heading(line), F.length(F.regexp_extract(strip(line), HEADING, 1)))


def formula_bodies(raw: Column) -> Column:
    return F.regexp_extract_all(raw, F.lit(FORMULA), F.lit(1))


def formula_name(body: Column) -> Column:
    """First bold run without markup and without trailing name marks; null without one."""
    name = F.regexp_replace(strip_inline(F.regexp_extract(body, r"(?d)\*\*(.*?)\*\*", 1)), "[方：:]+$", "")
    return F.when(body.rlike(r"(?d)\*\*.*?\*\*"), name)


def split_dose(dose: Column) -> Column:
    """struct(dose, preparation) of a dose run, split at its first comma; empty parts are null."""

    def cut(d):
        parts = F.split(d, "[，,]", 2)
        blank = lambda c: F.nullif(strip(c), F.lit(""))
        return F.struct(blank(F.get(parts, 0)).alias("dose"), blank(F.get(parts, 1)).alias("preparation"))

    return let(strip_inline(dose), cut)


def formula_ingredients(body: Column) -> Column:
    """array<struct<herb, dose, preparation>> of all ``herb<l>dose</l>`` runs."""
    herbs = F.regexp_extract_all(body, F.lit(HERB_DOSE), F.lit(1))
    doses = F.transform(F.regexp_extract_all(body, F.lit(HERB_DOSE), F.lit(2)), split_dose)
    return F.zip_with(herbs, doses, lambda h, d: F.struct(h.alias("herb"), d["dose"].alias("dose"), d["preparation"].alias("preparation")))


def parse_formula(body: Column) -> Column:
    return F.struct(formula_name(body).alias("formula_name"), formula_ingredients(body).alias("ingredients"), strip_inline(body).alias("text"))


def extract_formulas(raw: Column) -> Column:
    """All formula blocks of a passage, parsed."""
    empty = "array<struct<formula_name:string,ingredients:array<struct<herb:string,dose:string,preparation:string>>,text:string>>"
    return F.when(F.contains(raw, F.lit("<F>")), F.transform(formula_bodies(raw), parse_formula)).otherwise(F.array().cast(empty))


def to_simplified(text: Column, table: dict[str, str] | None = None) -> Column:
    """Character by character after a table; the identity without one."""
    return F.translate(text, "".join(table), "".join(table.values())) if table else text


def slugify(name: Column) -> Column:
    return F.regexp_replace(strip(name), rf"[{WS}/]+", "_")


def book_url(book_id: Column, homepage: str = SOURCE_HOMEPAGE) -> Column:
    return F.concat(F.lit(f"{homepage}book/"), book_id, F.lit("/"))


def passage_id(book_id: Column, path: Column, text: Column, idx: Column) -> Column:
    key = F.concat_ws("|", book_id, F.array_join(path, ">"), idx.cast("string"), F.substring(text, 1, 32))
    return F.concat_ws("::", book_id, F.format_string("%04d", idx), F.substring(F.sha1(key), 1, 12))


def item_id(book_id: Column, task: Column, passage: Column, salt: Column) -> Column:
    return F.concat_ws("::", book_id, task, F.substring(F.sha1(F.concat_ws("|", passage, task, salt)), 1, 10))


def contains(source: Column, normalized_source: Column, needle: Column) -> Column:
    """Null and empty needles are contained; else a raw match, else one of the normal forms."""
    raw = needle.isNull() | (needle == "") | F.contains(source, needle)
    return F.coalesce(raw | F.contains(normalized_source, normalize(needle)), F.lit(False))


def mentions_restricted_herb(text: Column) -> Column:
    return F.coalesce(contains_any(text, SAFETY_HERBS), F.lit(False))


def safety_note(text: Column) -> Column:
    return F.when(mentions_restricted_herb(text), SAFETY_NOTE).otherwise("")


def evidence_chapter(path: Column, chapter: Column) -> Column:
    return F.when(F.size(path) > 0, F.array_join(path, " · ")).otherwise(chapter)


def json_object(reply: Column) -> Column:
    """From the first opening to the last closing brace, if that is JSON; else null. A VARIANT."""
    return F.try_parse_json(F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit("")))
