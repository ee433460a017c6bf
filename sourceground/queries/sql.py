"""The same operators in DuckDB's SQL, as common table expressions over the driver tables."""

from __future__ import annotations

from ..functions.lookups import CATEGORY_LEVEL1, CATEGORY_TASKS, CORPUS_VERSION, DEFAULT_TASKS, META_KEYS, PUNCTUATION, SAFETY_HERBS, SAFETY_NOTE, SOURCE_HOMEPAGE, SOURCE_ID
from ..operators.generate import QUESTION_T1, QUESTION_T6
from .fixtures import FILES, PILOTS

W = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
HEAD = rf"^(={{3,}})[{W}]*([^=].*?)[{W}]*(={{3,}})[{W}]*$"
HERB = rf"([\x{{3400}}-\x{{9fff}}]+)[{W}]*<l>[{W}]*(.*?)[{W}]*</l>"
BODY = rf"(?s)<F>[{W}]*(.*?)[{W}]*</F>"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(e: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(to)}, 'g')"


def strip(e: str) -> str:
    return sub(e, rf"^[{W}]+|[{W}]+$")


def label(e: str) -> str:
    return f"coalesce(list_filter(string_split({e}, ':'), lambda p: p NOT IN ('', 'book', 'page'))[-1], '')"


def crossrefs(e: str) -> str:
    pieces, labels = f"string_split_regex({e}, {q(r'\[\[.*?\]\]')})", f"list_transform(regexp_extract_all({e}, {q(r'\[\[(.*?)\]\]')}, 1), lambda x: {label('x')})"
    return f"(CASE WHEN contains({e}, '[[') THEN array_to_string(list_transform(list_zip({pieces}, {labels}), lambda z: z[1] || coalesce(z[2], '')), '') ELSE {e} END)"


def strip_inline(e: str, keep_dose: bool = True) -> str:
    e = crossrefs(sub(e, r"(?s)\(\(.*?\)\)"))
    e = sub(sub(e, r"\*\*(.*?)\*\*", r"\1"), r"__(.*?)__", r"\1")
    e = sub(e, rf"<l>[{W}]*(.*?)[{W}]*</l>", r"\1" if keep_dose else "")
    e = sub(sub(e, r"<[#&~]/>"), rf"</?[A-Za-z][A-Za-z0-9]*[{W}]*/?>")
    return strip(sub(sub(e, r"[ \t]+"), r"\x{3000}{2,}", "　"))


def normalize(e: str) -> str:
    return sub(strip_inline(e, False), r"[^\p{L}\p{N}_\x{3400}-\x{9fff}\x{f900}-\x{faff}]")


def bare(e: str) -> str:
    return f"translate({e}, {q(PUNCTUATION)}, '')"


def found(needle: str, source: str = "raw_text_trad", normal: str = "normalized_text") -> str:
    return f"coalesce({needle} IS NULL OR {needle} = '' OR contains({source}, {needle}) OR contains({normal}, {normalize(needle)}), false)"


def restricted(e: str) -> str:
    return f"coalesce(regexp_matches({e}, {q('|'.join(SAFETY_HERBS))}), false)"


def dose_part(e: str, k: int) -> str:
    s = strip_inline(e)
    whole = {1: sub(s, r"(?s)[，,].*$"), 2: f"(CASE WHEN regexp_matches({s}, '[，,]') THEN {sub(s, '(?s)^[^，,]*[，,]')} END)"}[k]
    return f"nullif({strip(whole)}, '')"


def level1(e: str) -> str:
    pairs = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CATEGORY_LEVEL1.items())
    first = f"regexp_extract({strip(e)}, '^[^{W}]+')"
    return f"(CASE WHEN coalesce({strip(e)}, '') = '' THEN '未分類' ELSE CASE {first} {pairs} ELSE '其他' END END)"


def percent(e: str) -> str:
    n = f"try_cast(nullif({strip(sub(strip(e), '%+$'))}, '') AS double)"
    return f"(CASE WHEN NOT isnan({n}) THEN try_cast(trunc({n}) AS int) END)"


def tier(e: str) -> str:
    p = percent(e)
    return f"(CASE WHEN {p} IS NULL OR {p} = 0 THEN 'unscored' WHEN {p} >= 80 THEN 'test' WHEN {p} >= 50 THEN 'candidate' ELSE 'explore' END)"


def tasks(e: str) -> str:
    lists = " ".join(f"WHEN {q(k)} THEN {['T1', *v]}" for k, v in CATEGORY_TASKS.items())
    return f"(CASE {e} {lists} ELSE {['T1', *DEFAULT_TASKS]} END)"


def meta(key: str) -> str:
    return f"list_filter(pairs, lambda p: p.k = {q(key)})[-1].v"


UPTO = "OVER (PARTITION BY book_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _level(n: int) -> str:
    return f"max(CASE WHEN is_heading AND eq_len = {n} THEN line_no END) {UPTO} AS l{n}, last(CASE WHEN is_heading AND eq_len = {n} THEN title END IGNORE NULLS) {UPTO} AS t{n}"


PILOT_ROWS = ", ".join(f"({q(p)}, {i}, {q(b)}, {j})" for i, (p, bs) in enumerate(PILOTS.items()) for j, b in enumerate(bs))

ING = "list_transform(regexp_extract_all(body, {h}, 1), lambda x, i: {{'herb': x, 'dose': {d}, 'prep': {p}}})".format(
    h=q(HERB), d=dose_part(f"regexp_extract_all(body, {q(HERB)}, 2)[i]", 1), p=dose_part(f"regexp_extract_all(body, {q(HERB)}, 2)[i]", 2)
)

CTES = f"""
WITH files AS ({FILES}),
menu AS (SELECT book_id, unnest(string_split_regex(regexp_extract(content, '(?s)<menu>(.*?)</menu>', 1), {q(LINE_END)})) AS line,
  generate_subscripts(string_split_regex(regexp_extract(content, '(?s)<menu>(.*?)</menu>', 1), {q(LINE_END)}), 1) AS pos FROM files WHERE file_name = 'menu.txt'),
listed AS (SELECT m.book_id, f.file_name, m.pos AS key FROM menu m JOIN files f ON f.book_id = m.book_id AND f.file_name = {strip("split_part(m.line, '|', 1)")} || '.txt'),
numbered AS (SELECT book_id, file_name, cast(regexp_extract(file_name, '^[0-9]+') AS bigint) AS key FROM files
  WHERE regexp_matches(file_name, '^[0-9]+[.]txt$') AND book_id NOT IN (SELECT book_id FROM listed)),
alone AS (SELECT book_id, file_name, 0 AS key FROM files WHERE file_name = 'index.txt' AND book_id NOT IN (SELECT book_id FROM listed UNION ALL SELECT book_id FROM numbered)),
ordered AS (SELECT book_id, file_name, row_number() OVER (PARTITION BY book_id ORDER BY key, file_name) AS file_ord
  FROM (SELECT * FROM listed UNION ALL SELECT * FROM numbered UNION ALL SELECT * FROM alone)),
bodies AS (SELECT book_id, file_ord, string_split_regex(CASE WHEN file_name = 'index.txt' THEN regexp_replace(content, '(?s)<book>(.*?)</book>', '', 'g') ELSE content END, {q(LINE_END)}) AS a
  FROM files JOIN ordered USING (book_id, file_name)),
trimmed AS (SELECT book_id, file_ord, CASE WHEN a[-1] = '' THEN a[1:len(a) - 1] ELSE a END AS a FROM bodies),
pieces AS (SELECT book_id, file_ord, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM trimmed),
lines AS (SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY file_ord, pos) AS line_no, line FROM pieces),
heads AS (SELECT *, {strip("line")} AS s FROM lines),
heads2 AS (SELECT *, CASE WHEN regexp_matches(s, {q(HEAD)}) AND len(regexp_extract(s, {q(HEAD)}, 1)) = len(regexp_extract(s, {q(HEAD)}, 3)) THEN len(regexp_extract(s, {q(HEAD)}, 1)) END AS eq_len FROM heads),
heads3 AS (SELECT *, CASE WHEN eq_len IS NOT NULL THEN {strip_inline(f"regexp_extract(s, {q(HEAD)}, 2)")} END AS title,
  CASE WHEN contains(s, '</F>') THEN false WHEN contains(s, '<F>') AND eq_len IS NULL THEN true END AS mark FROM heads2),
states AS (SELECT *, coalesce(last(mark IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS in_block_before FROM heads3),
states2 AS (SELECT *, eq_len IS NOT NULL AND NOT in_block_before AS is_heading FROM states),
states3 AS (SELECT *, (in_block_before OR contains(s, '<F>')) AND NOT is_heading AS in_block FROM states2),
states4 AS (SELECT *, is_heading OR (s = '' AND NOT in_block) AS is_break FROM states3),
marked AS (SELECT *, sum(CASE WHEN is_break THEN 1 ELSE 0 END) {UPTO} AS grp FROM states4),
levels AS (SELECT *, {", ".join(_level(n) for n in (6, 5, 4, 3))} FROM marked),
pathed AS (SELECT *, list_filter([t6, CASE WHEN l5 > coalesce(l6, -1) THEN t5 END, CASE WHEN l4 > greatest(coalesce(l6, -1), coalesce(l5, -1)) THEN t4 END,
  CASE WHEN l3 > greatest(coalesce(l6, -1), coalesce(l5, -1), coalesce(l4, -1)) THEN t3 END], lambda t: t IS NOT NULL) AS heading_path FROM levels),
grouped AS (SELECT book_id, grp, min(line_no) AS first_line, arg_min(heading_path, line_no) AS heading_path, string_agg(line, chr(10) ORDER BY line_no) AS joined FROM pathed WHERE NOT is_break GROUP BY book_id, grp),
cleaned AS (SELECT *, {strip("joined")} AS raw_joined FROM grouped),
cleaned2 AS (SELECT *, {strip_inline("raw_joined")} AS text FROM cleaned),
bodies2 AS (SELECT *, CASE WHEN contains(raw_joined, '<F>') THEN regexp_extract_all(raw_joined, {q(BODY)}, 1) ELSE [] END AS bodies,
  row_number() OVER (PARTITION BY book_id ORDER BY first_line) - 1 AS passage_idx FROM cleaned2 WHERE text <> ''),
passages AS (SELECT book_id, passage_idx, heading_path, raw_joined, text, bodies FROM bodies2),
formula_rows AS (SELECT book_id, passage_idx, unnest(bodies) AS body, generate_subscripts(bodies, 1) - 1 AS no FROM passages),
formulas AS (SELECT book_id, passage_idx, no, body, CASE WHEN regexp_matches(body, {q(r'\*\*.*?\*\*')}) THEN {sub(strip_inline(f"regexp_extract(body, {q(r'\*\*(.*?)\*\*')}, 1)"), '[方：:]+$')} END AS formula_name,
  {ING} AS ings, {strip_inline("body")} AS ftext FROM formula_rows),
meta_lines AS (SELECT book_id, list_filter(list_transform(string_split_regex(regexp_extract(content, '(?s)<book>(.*?)</book>', 1), {q(LINE_END)}), lambda x: {strip("x")}), lambda x: contains(x, '=')) AS ls FROM files WHERE file_name = 'index.txt'),
metas AS (SELECT book_id, list_transform(ls, lambda x: {{'k': {strip("split_part(x, '=', 1)")}, 'v': {strip("substr(x, instr(x, '=') + 1)")}}}) AS pairs FROM meta_lines),
catalog AS (SELECT book_id, coalesce({meta("書名")}, book_id) AS book_title_trad, {meta("作者")} AS author, {meta("朝代")} AS dynasty, {meta("年份")} AS year,
  {level1(meta("分類"))} AS category_level_1, coalesce({strip(meta("分類"))}, '') AS category_level_2, coalesce(nullif({meta("參本")}, ''), nullif({meta("底本")}, ''), {meta("版本")}) AS base_text,
  {meta("品質")} AS quality_score_source, {tier(meta("品質"))} AS quality_tier, {q(SOURCE_HOMEPAGE + "book/")} || book_id || '/' AS source_url,
  array_to_string(list_sort(list_transform(list_filter(pairs, lambda p: p.k NOT IN ({", ".join(map(q, META_KEYS))})), lambda p: p.k || '=' || p.v)), ';') AS extra FROM metas),
corpus_all AS (SELECT p.book_id || '::' || printf('%04d', passage_idx) || '::' || substr(sha1(p.book_id || '|' || array_to_string(heading_path, '>') || '|' || passage_idx || '|' || substr(text, 1, 32)), 1, 12) AS passage_id,
  p.book_id, passage_idx, heading_path, heading_path[1] AS chapter, heading_path[2] AS section_title, text AS raw_text_trad, {normalize("text")} AS normalized_text, len(bodies) AS n_formulas,
  {tasks("category_level_1")} AS candidate_tasks, c.* EXCLUDE (book_id) FROM passages p JOIN catalog c ON c.book_id = p.book_id),
corpus AS (SELECT * FROM corpus_all WHERE len(raw_text_trad) >= 12),
pilots AS (SELECT * FROM (VALUES {PILOT_ROWS}) AS t(pilot, pilot_ord, book_id, book_ord)),
pcorpus AS (SELECT c.*, pilot, pilot_ord, book_ord FROM corpus c JOIN pilots USING (book_id)),
t1 AS (SELECT book_id || '::T1::' || substr(sha1(passage_id || '|T1|'), 1, 10) AS item_id, 'punctuation_restoration' AS task, 'T1' AS task_code, {q(QUESTION_T1)} AS question, {bare("raw_text_trad")} AS context,
  raw_text_trad AS answer_text, NULL AS formula_name, NULL AS ings, [raw_text_trad] AS spans, '' AS safety_note, 0 AS formula_no, 0 AS task_rank, c.* FROM corpus c
  WHERE len(raw_text_trad) BETWEEN 20 AND 220 AND {bare("raw_text_trad")} <> raw_text_trad AND list_contains(candidate_tasks, 'T1')),
t6 AS (SELECT c.book_id || '::T6::' || substr(sha1(passage_id || '|T6|' || no), 1, 10) AS item_id, 'formula_structure_parsing' AS task, 'T6' AS task_code, {q(QUESTION_T6)} AS question, coalesce(nullif(ftext, ''), raw_text_trad) AS context,
  NULL AS answer_text, formula_name, ings, list_transform(ings, lambda i: i.herb) AS spans, CASE WHEN {restricted("ftext")} THEN {q(SAFETY_NOTE)} ELSE '' END AS safety_note, no AS formula_no, 1 AS task_rank, c.*
  FROM corpus c JOIN formulas f ON f.book_id = c.book_id AND f.passage_idx = c.passage_idx WHERE formula_name <> '' AND len(ings) > 0 AND list_contains(candidate_tasks, 'T6')),
items AS (SELECT * FROM t1 UNION ALL SELECT * FROM t6),
pitems AS (SELECT i.*, pilot, pilot_ord, book_ord FROM items i JOIN pilots USING (book_id)),
broken AS (SELECT * REPLACE (CASE passage_idx % 9 WHEN 0 THEN list_concat(spans, ['不存在之文', '']) ELSE spans END AS spans,
    CASE passage_idx % 9 WHEN 3 THEN '' ELSE book_title_trad END AS book_title_trad,
    CASE passage_idx % 9 WHEN 4 THEN context || '贅' ELSE context END AS context,
    CASE passage_idx % 9 WHEN 7 THEN '' ELSE safety_note END AS safety_note,
    CASE passage_idx % 9 WHEN 6 THEN list_concat(ings, [{{'herb': '虛構藥', 'dose': '九萬兩', 'prep': NULL}}]) ELSE ings END AS ings),
  CASE passage_idx % 9 WHEN 1 THEN 'external_required' ELSE 'direct' END AS inference_level,
  CASE passage_idx % 9 WHEN 2 THEN 'other' ELSE {q(SOURCE_ID)} END AS source_of,
  CASE passage_idx % 9 WHEN 5 THEN ['甲', '乙'] WHEN 8 THEN ['甲', '乙', '丙', '丁'] ELSE [] END AS options,
  CASE WHEN passage_idx % 9 = 8 OR passage_idx % 18 = 5 THEN [{{'o': '乙', 'r': '', 'e': false}}, {{'o': '丙', 'r': '無據', 'e': true}}] ELSE [] END AS distractors FROM items),
checks AS (SELECT *,
  list_concat(CASE WHEN book_title_trad = '' THEN ['title_missing'] ELSE [] END, CASE WHEN source_of <> {q(SOURCE_ID)} THEN ['source_id'] ELSE [] END) AS e_provenance,
  list_transform(list_filter(spans, lambda s: NOT {found("s")}), lambda s: 'span:' || substr(s, 1, 24)) AS e_spans,
  CASE WHEN inference_level = 'external_required' THEN ['external_required'] ELSE [] END AS e_level,
  CASE WHEN task_code = 'T6' THEN list_concat(CASE WHEN NOT {found("formula_name")} THEN ['name:' || formula_name] ELSE [] END,
    flatten(list_transform(ings, lambda i: list_concat(CASE WHEN NOT {found("i.herb")} THEN ['herb:' || i.herb] ELSE [] END, CASE WHEN i.dose IS NOT NULL AND NOT {found("i.dose")} THEN ['dose:' || i.dose] ELSE [] END)))) ELSE [] END AS e_formula,
  CASE WHEN task_code = 'T1' AND {bare("answer_text")} <> {bare("context")} THEN ['punctuation_changes_text'] ELSE [] END AS e_marks,
  list_transform(list_filter(distractors, lambda d: d.r = ''), lambda d: 'distractor_without_reason') AS e_distractors,
  list_transform(list_filter(distractors, lambda d: d.r <> '' AND d.e), lambda d: 'distractor_needs_outside_knowledge') AS w_distractors FROM broken),
checks2 AS (SELECT *, CASE WHEN len(options) > 0 THEN list_concat(CASE WHEN len(options) < 3 THEN ['few_options:' || len(options)] ELSE [] END, e_distractors) ELSE [] END AS e_mcq,
  CASE WHEN len(options) > 0 THEN w_distractors ELSE [] END AS w_mcq,
  CASE WHEN {restricted("context || coalesce(answer_text, concat_ws(' ', formula_name, array_to_string(list_transform(ings, lambda i: concat_ws(' ', i.herb, i.dose, i.prep, i.herb || coalesce(i.dose, '') || coalesce(i.prep, ''))), ' '))) || array_to_string(options, ' ')")} AND safety_note = '' THEN ['safety_note_missing'] ELSE [] END AS w_safety FROM checks),
checked AS (SELECT *, list_concat(e_provenance, e_spans, e_level, e_formula, e_marks, e_mcq) AS errors, list_concat(w_mcq, w_safety) AS warnings FROM checks2)
"""  # noqa: E501

VERSION = CORPUS_VERSION
