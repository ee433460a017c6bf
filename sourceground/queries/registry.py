"""A query and its SQL for each operator, over tables derived from the driver's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify
from ..functions import text as X
from ..functions.lookups import SOURCE_ID
from ..operators import conformance as K
from ..operators import corpus as C
from ..operators import generate as G
from ..operators import model as M
from ..operators import passages as W
from ..operators import report as A
from ..operators import sampling as R
from ..operators import validate as V
from ..plans import jobs as J
from ..sources import books as S
from ..sources import io
from ..sources import splits
from ..sources.scratch import scratch_path, stored, stored_by
from . import fixtures as D
from . import sql as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None, ctes: bool = True):
    def add(f):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            out = f(spark, sf)  # whole numbers as DuckDB has them
            return out.withColumns(wide) if (wide := {c: F.col(c).cast("long") for c, kind in out.dtypes if kind == "int"}) else out

        QUERIES[name] = run
        if oracle is not None:
            ORACLE_SQL[name] = f"{Q.CTES} {oracle}" if ctes else oracle
        return f

    return add


# ---------------------------------------------------------------- strings
MARKUP = """
SELECT doc_id, CASE doc_id % 8
  WHEN 0 THEN '((註' || chr(10) || substr(text, 1, 40) || '))' || substr(text, 41)
  WHEN 1 THEN '見[[book:' || source || ':]]及[[page:]][[a:b]]' || text
  WHEN 2 THEN '**' || substr(text, 1, 12) || '**' || substr(text, 13)
  WHEN 3 THEN '__' || lang || '__，' || text
  WHEN 4 THEN '人參<l> 三兩，去蘆 </l>，甘草<l>一' || chr(10) || '錢</l>' || text
  WHEN 5 THEN '甲<#/>乙<&/>丙<~/>丁<z>戊</z><br/>　　　己 ' || text || '　'
  WHEN 6 THEN '「' || text || '」（' || source || '）—…'
  ELSE text END AS m
FROM documents WHERE text IS NOT NULL"""
M_ = f"WITH d_markup AS ({MARKUP}) "


def markup(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(MARKUP.replace("FROM documents", "FROM {d}"), d=D.table(spark, sf, "documents"))


def scalar(name: str, column: Callable[[Column], Column], oracle: str) -> None:
    query(name, M_ + f"SELECT doc_id, {oracle} AS v FROM d_markup", ctes=False)(lambda s, sf: markup(s, sf).select("doc_id", column(F.col("m")).alias("v")))


scalar("x01_strip_inline", X.strip_inline, Q.strip_inline("m"))
scalar("x01_strip_inline_no_dose", lambda c: X.strip_inline(c, False), Q.strip_inline("m", False))
scalar("x02_crossrefs", X.replace_crossrefs, Q.crossrefs("m"))
scalar("x03_normalize", X.normalize, Q.normalize("m"))
scalar("x04_remove_punctuation", X.remove_punctuation, Q.bare("m"))
scalar("x12_slugify", X.slugify, Q.sub(Q.strip("m"), rf"[{Q.W}/]+", "_"))
scalar("x17_safety_note", lambda c: X.safety_note(F.concat(c, F.when(F.col("doc_id") % 3 == 0, "附子").otherwise("甘草"))), f"CASE WHEN {Q.restricted('m || CASE WHEN doc_id % 3 = 0 THEN ' + Q.q('附子') + ' ELSE ' + Q.q('甘草') + ' END')} THEN {Q.q(Q.SAFETY_NOTE)} ELSE '' END")

TABLE = {"e": "ē", "a": "α", "見": "见", "參": "参", "錢": "钱"}
scalar("x11_to_simplified", lambda c: X.to_simplified(c, TABLE), f"translate(m, {Q.q(''.join(TABLE))}, {Q.q(''.join(TABLE.values()))})")


@query("x05_headings", "SELECT book_id, line_no, title, eq_len FROM heads3 WHERE eq_len IS NOT NULL")
def x05(spark, sf):
    rows = D.lines(spark, sf).select("book_id", "line_no", X.heading_title(F.col("line")).alias("title"), X.heading_signs(F.col("line")).alias("eq_len"))
    return rows.where("eq_len is not null")


@query("x06_formula_bodies", "SELECT book_id, passage_idx, no, body FROM formula_rows")
def x06(spark, sf):
    return D.passages(spark, sf).select("book_id", "passage_idx", F.posexplode(X.formula_bodies(F.col("raw_joined"))).alias("no", "body"))


@query("x07_formula_names", "SELECT book_id, passage_idx, no, formula_name, ftext FROM formulas")
def x07(spark, sf):
    return D.passages(spark, sf).select("book_id", "passage_idx", F.posexplode("formulas").alias("no", "f")).select("book_id", "passage_idx", "no", "f.formula_name", F.col("f.text").alias("ftext"))


@query("x08_ingredients", "SELECT book_id, passage_idx, no, i.herb AS herb, i.dose AS dose, i.prep AS prep FROM (SELECT book_id, passage_idx, no, unnest(ings) AS i FROM formulas)")
def x08(spark, sf):
    rows = D.passages(spark, sf).select("book_id", "passage_idx", F.posexplode("formulas").alias("no", "f")).select("book_id", "passage_idx", "no", F.explode("f.ingredients").alias("i"))
    return rows.select("book_id", "passage_idx", "no", "i.herb", "i.dose", F.col("i.preparation").alias("prep"))


@query("x09_metadata", "SELECT book_id, p.k AS k, list_filter(pairs, lambda z: z.k = p.k)[-1].v AS v FROM (SELECT DISTINCT book_id, pairs, unnest(pairs) AS p FROM metas) GROUP BY ALL")
def x09(spark, sf):
    return D.files(spark, sf).where("file_name = 'index.txt'").select("book_id", F.explode(S.metadata_map(F.col("content"))).alias("k", "v"))


@query("x10_metadata_fields", "SELECT book_id, book_title_trad, base_text, extra FROM catalog")
def x10(spark, sf):
    extra = F.array_join(F.array_sort(F.transform(F.map_entries("extra"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return S.catalog(D.files(spark, sf)).select("book_id", "book_title_trad", "base_text", extra.alias("extra"))


@query("x13_book_url", f"SELECT DISTINCT source, {Q.q(Q.SOURCE_HOMEPAGE + 'book/')} || source || '/' AS url FROM documents", ctes=False)
def x13(spark, sf):
    return D.table(spark, sf, "documents").select("source", X.book_url(F.col("source")).alias("url")).distinct()


@query("x14_passage_id", "SELECT passage_id, book_id, passage_idx FROM corpus_all")
def x14(spark, sf):
    return D.corpus(spark, sf, 0).select("passage_id", "book_id", "passage_idx")


@query("x15_item_id", "SELECT doc_id, source || '::T2::' || substr(sha1(cast(doc_id AS string) || '|T2|m' || lang), 1, 10) AS item_id FROM documents", ctes=False)
def x15(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", X.item_id(F.col("source"), F.lit("T2"), F.col("doc_id").cast("string"), F.concat(F.lit("m"), "lang")).alias("item_id"))


SPAN = "CASE WHEN doc_id % 9 = 8 THEN NULL ELSE CASE doc_id % 4 WHEN 0 THEN substr(text, 5, 30) WHEN 1 THEN replace(substr(text, 5, 30), ' ', '，') WHEN 2 THEN '' ELSE 'zz' || substr(text, 5, 9) END END"


@query("x16_contains", f"SELECT doc_id, {Q.found(SPAN, 'text', Q.normalize('text'))} AS v FROM documents", ctes=False)
def x16(spark, sf):
    docs = D.table(spark, sf, "documents").withColumn("span", F.expr(SPAN)).withColumn("normal", X.normalize(F.col("text")))
    return docs.select("doc_id", X.contains(F.col("text"), F.col("normal"), F.col("span")).alias("v"))


@query("x18_answer_text", """SELECT item_id, coalesce(answer_text, concat_ws(' ', formula_name, array_to_string(list_transform(ings,
  lambda i: concat_ws(' ', i.herb, i.dose, i.prep, i.herb || coalesce(i.dose, '') || coalesce(i.prep, ''))), ' '))) AS v FROM items""")
def x18(spark, sf):
    return items(spark, sf).select("item_id", G.answer_scan_text().alias("v"))


@query("x19_evidence_chapter", "SELECT passage_id, CASE WHEN len(heading_path) > 0 THEN array_to_string(heading_path, ' · ') ELSE chapter END AS chapter FROM corpus")
def x19(spark, sf):
    return D.corpus(spark, sf).select("passage_id", X.evidence_chapter(F.col("heading_path"), F.col("chapter")).alias("chapter"))


@query("x20_json_object", "SELECT event_id, json_extract_string(regexp_extract('note: ' || props || ' end', '(?s)\\{.*\\}'), '$.k') AS v, regexp_matches(props, '\\{') AS has FROM events", ctes=False)
def x20(spark, sf):
    data = X.json_object(F.concat(F.lit("note: "), "props", F.lit(" end")))
    return D.table(spark, sf, "events").select("event_id", F.try_variant_get(data, "$.k", "string").alias("v"), F.contains("props", F.lit("{")).alias("has"))


# ---------------------------------------------------------------- sources
@query("s01_book_files", "SELECT f.book_id, f.file_name, sha256(content) AS content FROM files f WHERE book_id IN (SELECT book_id FROM files WHERE file_name = 'index.txt')")
def s01(spark, sf):
    root = scratch_path(spark, "books")
    S.write_book_files(D.files(spark, sf), root).write.format("noop").mode("overwrite").save()
    return S.read_book_files(spark, root).select("book_id", "file_name", F.sha2("content", 256).alias("content"))


@query("s03_jsonl_blank_lines", "SELECT doc_id, source FROM documents", ctes=False)
def s03(spark, sf):
    path = scratch_path(spark, "lines")
    docs = D.table(spark, sf, "documents")
    line = F.to_json(F.struct("doc_id", "source"))
    docs.select(F.explode(F.array(line, F.lit(""))).alias("value")).write.mode("overwrite").text(path)
    return io.read_jsonl(spark, path, "doc_id long, source string")


@query("s04_done_keys", "SELECT DISTINCT source || '::' || cast(doc_id % 50 AS string) AS passage_id, 'T2' AS task_code FROM documents WHERE doc_id % 3 <> 0", ctes=False)
def s04(spark, sf):
    path = scratch_path(spark, "lines")
    key = F.concat("source", F.lit("::"), (F.col("doc_id") % 50).cast("string"))
    line = F.to_json(F.struct(key.alias("passage_id"), F.lit("T2").alias("task_code")))
    cut = F.when(F.col("doc_id") % 3 == 0, line.substr(F.lit(1), F.length(line) - 4)).otherwise(line)
    D.table(spark, sf, "documents").select(cut.alias("value")).write.mode("overwrite").text(path)
    return io.read_done(spark, path)


@query("s02_file_order", "SELECT book_id, file_name, file_ord FROM ordered")
def s02(spark, sf):
    return S.file_order(D.files(spark, sf))


@query("s05_jsonl_round_trip", "SELECT doc_id, lang, source, n_chars FROM documents", ctes=False)
def s05(spark, sf):
    docs = D.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    path = scratch_path(spark, "jsonl")
    io.write_jsonl(docs, path)
    return io.read_jsonl(spark, path, docs.schema).select("doc_id", "lang", "source", "n_chars")


@query("s06_stats_document", """, st AS (SELECT pilot, count(*) AS n FROM pcorpus GROUP BY pilot) SELECT count(*) AS pilots, cast(sum(n) AS bigint) AS passages FROM st""")
def s06(spark, sf):
    doc = _release(spark, sf)["document"]
    schema = "struct<pilots:array<struct<pilot:string,passages_full:bigint>>>"
    got = doc.select(F.explode(F.from_json("value", schema)["pilots"]).alias("p"))
    return got.agg(F.count(F.lit(1)).alias("pilots"), F.sum("p.passages_full").alias("passages"))


# ---------------------------------------------------------------- classification and corpus
@query("p01_category", f"SELECT book_id, {Q.level1(Q.meta('分類'))} AS level1, coalesce({Q.strip(Q.meta('分類'))}, '') AS level2 FROM metas")
def p01(spark, sf):
    return S.catalog(D.files(spark, sf)).select("book_id", F.col("category_level_1").alias("level1"), F.col("category_level_2").alias("level2"))


RAW_QUALITY = "CASE doc_id % 6 WHEN 0 THEN cast(n_chars % 101 AS string) || '%' WHEN 1 THEN ' ' || cast(quality AS string) || ' % ' WHEN 2 THEN cast(n_chars % 997 AS string) || '.75%%' WHEN 3 THEN 'x' || lang WHEN 4 THEN '' ELSE NULL END"


@query("p02_quality_percent", f"SELECT doc_id, cast({Q.percent('r')} AS bigint) AS v FROM (SELECT doc_id, {RAW_QUALITY} AS r FROM documents JOIN labels USING (doc_id))", ctes=False)
def p02(spark, sf):
    rows = D.table(spark, sf, "documents").join(D.table(spark, sf, "labels"), "doc_id").withColumn("r", F.expr(RAW_QUALITY))
    return rows.select("doc_id", classify.quality_percent(F.col("r")).alias("v"))


@query("p03_quality_tier", f"SELECT doc_id, {Q.tier('r')} AS tier, {Q.tier('r')} = 'test' AS eligible FROM (SELECT doc_id, {RAW_QUALITY} AS r FROM documents JOIN labels USING (doc_id))", ctes=False)
def p03(spark, sf):
    rows = D.table(spark, sf, "documents").join(D.table(spark, sf, "labels"), "doc_id").withColumn("tier", classify.quality_tier(F.expr(RAW_QUALITY)))
    return rows.select("doc_id", "tier", classify.eligible_for_test(F.col("tier")).alias("eligible"))


@query("p04_candidate_tasks", f"SELECT book_id, array_to_string({Q.tasks('category_level_1')}, ' ') AS tasks FROM catalog")
def p04(spark, sf):
    return S.catalog(D.files(spark, sf)).select("book_id", F.array_join(classify.candidate_tasks(F.col("category_level_1")), " ").alias("tasks"))


@query("p05_catalog", "SELECT * FROM catalog")
def p05(spark, sf):
    c = S.catalog(D.files(spark, sf))
    extra = F.array_join(F.array_sort(F.transform(F.map_entries("extra"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return c.select("book_id", "book_title_trad", "author", "dynasty", "year", "category_level_1", "category_level_2", "base_text", "quality_score_source", "quality_tier", "source_url", extra.alias("extra"))


CORPUS_FLAT = "passage_id, book_id, passage_idx, chapter, section_title, raw_text_trad, normalized_text, n_formulas, book_title_trad, base_text, quality_tier, source_url"


@query("p06_corpus_record", f"SELECT {CORPUS_FLAT} FROM corpus")
def p06(spark, sf):
    return D.corpus(spark, sf).select("passage_id", "book_id", "passage_idx", "chapter", "section_title", "raw_text_trad", "normalized_text", F.size("formulas").alias("n_formulas"), "book_title_trad", "base_text", "quality_tier", "source_url")


@query("p07_min_length", "SELECT passage_id, passage_idx FROM corpus_all WHERE len(raw_text_trad) >= 40")
def p07(spark, sf):
    return D.corpus(spark, sf, 40).select("passage_id", "passage_idx")


@query("p08_pilot_selection", "SELECT pilot, cast(pilot_ord AS bigint) AS pilot_ord, cast(book_ord AS bigint) AS book_ord, passage_id FROM pcorpus")
def p08(spark, sf):
    return D.pilot_corpus(spark, sf).select("pilot", "pilot_ord", "book_ord", "passage_id")


WANTED = ["T1", "T2", "T8", "T11"]


@query("p09_routed_tasks", f"SELECT passage_id, unnest(list_intersect(candidate_tasks, {WANTED})) AS task_code FROM corpus")
def p09(spark, sf):
    return C.routed_tasks(D.corpus(spark, sf), WANTED).select("passage_id", "task_code")


@query("p10_formal_pool", "SELECT item_id FROM broken WHERE inference_level <> 'external_required' AND quality_tier = 'test'")
def p10(spark, sf):
    rows = corpus_(spark, sf)
    return C.formal_pool(broken(rows), rows).select("item_id")


@query("p11_corpus_violations", "SELECT passage_id, 'missing:book_title_simp' AS violations FROM corpus WHERE passage_idx % 5 = 0 UNION ALL SELECT passage_id, 'enum:quality_tier:bad' FROM corpus WHERE passage_idx % 5 = 1")
def p11(spark, sf):
    c = D.corpus(spark, sf)
    c = c.withColumn("book_title_simp", F.when(F.col("passage_idx") % 5 != 0, F.col("book_title_simp"))).withColumn("quality_tier", F.when(F.col("passage_idx") % 5 == 1, "bad").otherwise(F.col("quality_tier")))
    return K.corpus_violations(c).select("passage_id", F.array_join("violations", ";").alias("violations"))


@query("p12_item_violations", """SELECT item_id, CASE passage_idx % 8 WHEN 0 THEN 'missing:question' WHEN 1 THEN 'enum:difficulty:Odd' WHEN 2 THEN 'missing:answer' WHEN 3 THEN 'constant:evidence.source_id' WHEN 4 THEN 'missing:evidence.book_title_trad'
  WHEN 5 THEN 'missing:evidence' ELSE 'missing:answer;missing:evidence.source_id' END AS violations FROM items WHERE passage_idx % 8 < 7""")
def p12(spark, sf):
    i, k = items(spark, sf, ("passage_idx",)), F.col("passage_idx") % 8
    gone = lambda when, c: F.when(~when, F.col(c))
    e = F.col("evidence")
    source = F.when(k == 3, "elsewhere").when(k != 6, F.lit(SOURCE_ID))
    e = F.when(k != 5, e.withField("source_id", source).withField("book_title_trad", F.when(k != 4, e["book_title_trad"])))
    unanswered = k.isin(2, 6)
    i = i.withColumns({"question": gone(k == 0, "question"), "difficulty": F.when(k == 1, "Odd").otherwise(F.col("difficulty")), "evidence": e, "answer_text": gone(unanswered, "answer_text"), "answer_formula": gone(unanswered, "answer_formula")})
    return K.item_violations(i).select("item_id", F.array_join("violations", ";").alias("violations"))


@query("p12_item_documents", """SELECT item_id, CASE passage_idx % 8 WHEN 0 THEN 'missing:answer' WHEN 1 THEN 'type:options[1]:integer' WHEN 2 THEN 'type:evidence:string' WHEN 3 THEN 'missing:evidence.book_title_trad;constant:evidence.source_id' WHEN 4 THEN 'type:distractors[0].requires_external:string'
  WHEN 5 THEN 'type:evidence.spans[0]:boolean' ELSE 'enum:task_code:T99' END AS violations FROM items WHERE passage_idx % 8 < 7""")
def p12d(spark, sf):
    """Items as lines of JSON, as any producer may write them, of which seven in eight break the schema."""
    cases = """CASE passage_idx % 8 WHEN 0 THEN named_struct('drop', 'answer') WHEN 1 THEN named_struct('drop', 'options') WHEN 2 THEN named_struct('drop', 'evidence') WHEN 3 THEN named_struct('drop', 'evidence') WHEN 4 THEN named_struct('drop', 'distractors')
      WHEN 5 THEN named_struct('drop', 'evidence') WHEN 6 THEN named_struct('drop', 'task_code') END.drop"""
    value = """CASE passage_idx % 8 WHEN 0 THEN 'null' WHEN 1 THEN '["甲", 2, "丙"]' WHEN 2 THEN '"單"' WHEN 3 THEN '{"book_title_trad": null, "source_id": "x"}' WHEN 4 THEN '[{"option": "乙", "requires_external": "no"}]'
      WHEN 5 THEN '{"book_title_trad": "書", "source_id": "' || '@' || '", "spans": [true, "文"]}' WHEN 6 THEN '"T99"' END""".replace("@", SOURCE_ID)
    i = io.with_answer(items(spark, sf, ("passage_idx",))).withColumns({"broken": F.expr(cases), "value": F.expr(value)})
    entries = F.filter(F.array(*[F.struct(F.lit(c).alias("k"), F.coalesce(F.to_json(F.col(c)) if c in ("answer", "evidence", "options", "distractors") else F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1), F.lit("null")).alias("v")) for c in K.ITEM["properties"]]), lambda e: ~e["k"].eqNullSafe(F.col("broken")))
    body = F.concat_ws(", ", F.transform(entries, lambda e: F.concat(F.lit('"'), e["k"], F.lit('": '), e["v"])), F.when(F.col("broken").isNotNull(), F.concat(F.lit('"'), F.col("broken"), F.lit('": '), F.col("value"))))
    lines = i.select("item_id", F.concat(F.lit("{"), body, F.lit("}")).alias("line"))
    found = lines.select("item_id", K.document_violations(K.ITEM, F.try_parse_json("line")).alias("violations"))
    return found.where(F.size("violations") > 0).select("item_id", F.array_join("violations", ";").alias("violations"))


# ---------------------------------------------------------------- segmentation
@query("w01_book_lines", "SELECT book_id, line_no, line FROM lines")
def w01(spark, sf):
    return D.lines(spark, sf)


@query("w01_split_lines", "SELECT book_id, line_no, line FROM lines")
def w01s(spark, sf):
    """The same lines from files on disk, read in byte ranges."""
    root = scratch_path(spark, "books")
    S.write_book_files(D.files(spark, sf), root).write.format("noop").mode("overwrite").save()
    return splits.read_books(spark, root)[1]


@query("w02_level_ranks", "SELECT book_id, eq_len, dense_rank() OVER (PARTITION BY book_id ORDER BY eq_len DESC) - 1 AS depth FROM (SELECT DISTINCT book_id, eq_len FROM heads2 WHERE eq_len IS NOT NULL)")
def w02(spark, sf):
    return W.level_ranks(D.lines(spark, sf))


@query("w03_formula_state", "SELECT book_id, line_no, in_block_before, in_block FROM marked")
def w03(spark, sf):
    return W.mark_lines(D.lines(spark, sf)).select("book_id", "line_no", "in_block_before", "in_block")


@query("w04_passage_groups", "SELECT book_id, line_no, is_break, cast(grp AS bigint) AS grp FROM marked")
def w04(spark, sf):
    return W.mark_lines(D.lines(spark, sf)).select("book_id", "line_no", "is_break", "grp")


@query("w05_heading_path", "SELECT book_id, line_no, array_to_string(heading_path, '>') AS path FROM pathed WHERE NOT is_break")
def w05(spark, sf):
    return W.with_heading_path(D.lines(spark, sf)).where("not is_break").select("book_id", "line_no", F.array_join("heading_path", ">").alias("path"))


@query("w06_passages", "SELECT book_id, raw_joined, text, len(bodies) AS n_formulas FROM passages")
def w06(spark, sf):
    return D.passages(spark, sf).select("book_id", "raw_joined", "text", F.size("formulas").alias("n_formulas"))


@query("w07_passage_index", "SELECT book_id, passage_idx, text FROM passages")
def w07(spark, sf):
    return D.passages(spark, sf).select("book_id", "passage_idx", "text")


@query("w03_unclosed_blocks", "SELECT book_id, line_no FROM (SELECT book_id, line_no, in_block, s, row_number() OVER (PARTITION BY book_id ORDER BY line_no DESC) AS r FROM marked) WHERE r = 1 AND in_block AND NOT contains(s, '</F>')")
def w03u(spark, sf):
    return W.unclosed_blocks(D.lines(spark, sf))


# ---------------------------------------------------------------- generation
def corpus_(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus, stored for queries that read it more than once."""
    return stored(D.corpus(spark, sf), "corpus")


def items(spark: SparkSession, sf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return G.generate_items(corpus_(spark, sf), ["T1", "T6"], carry=carry)


def _ings(c: str) -> Column:
    return F.array_join(F.transform(c, lambda i: F.concat_ws("|", i["herb"], F.coalesce(i["dose"], F.lit("-")), F.coalesce(i["preparation"], F.lit("-")))), ";")


SQL_INGS = "array_to_string(list_transform(ings, lambda i: i.herb || '|' || coalesce(i.dose, '-') || '|' || coalesce(i.prep, '-')), ';')"


@query("g01_generate_t1", "SELECT item_id, question, context, answer_text, book_id, passage_id FROM t1")
def g01(spark, sf):
    c = D.corpus(spark, sf)
    return G.generate_t1(c).select("item_id", "question", "context", "answer_text", "book_id", "passage_id")


@query("g02_generate_t6", f"SELECT item_id, context, formula_name, {SQL_INGS} AS ings, array_to_string(spans, ';') AS spans, safety_note, formula_no FROM t6")
def g02(spark, sf):
    t6 = G.generate_t6(D.corpus(spark, sf).where(F.array_contains("candidate_tasks", "T6")))
    return t6.select("item_id", "context", "answer_formula.formula_name", _ings("answer_formula.ingredients").alias("ings"), F.array_join("evidence.spans", ";").alias("spans"), "safety_note", "formula_no")


@query("g03_generate_items", "SELECT item_id, task, task_code, cast(task_rank AS bigint) AS task_rank, book_title_trad, array_to_string(heading_path, ' · ') AS chapter FROM items")
def g03(spark, sf):
    return items(spark, sf).select("item_id", "task", "task_code", "task_rank", "evidence.book_title_trad", "evidence.chapter")


ALL_TASKS = [f"T{i}" for i in range(1, 13)]
MODEL_TASKS = [t for t in ALL_TASKS if t not in ("T1", "T6")]
JOBS = f", jobs AS (SELECT passage_id, passage_idx, unnest(list_filter(candidate_tasks, lambda t: t NOT IN ('T1', 'T6'))) AS task_code FROM corpus), done AS (SELECT * FROM jobs WHERE substr(sha1(passage_id || task_code), 1, 1) < '8')"


def jobs_and_done(spark: SparkSession, sf: str, full: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    jobs = G.model_jobs(full if full is not None else D.corpus(spark, sf), ALL_TASKS)
    return jobs, jobs.where(F.substring(F.sha1(F.concat("passage_id", "task_code")), 1, 1) < "8")


@query("g04_model_jobs", JOBS + " SELECT passage_id, task_code FROM jobs")
def g04(spark, sf):
    return jobs_and_done(spark, sf)[0].select("passage_id", "task_code")


@query("g05_prompts", JOBS + " SELECT passage_id, task_code, task_code IN ('T7', 'T8', 'T9', 'T11', 'T12') AS choice, task_code NOT IN ('T2', 'T6') AS levelled, true AS holds_text FROM jobs")
def g05(spark, sf):
    jobs = jobs_and_done(spark, sf)[0].withColumn("prompt", M.build_prompt(F.col("task_code"), "Expert"))
    has = lambda s: F.contains("prompt", F.lit(s))
    text = F.get_json_object(F.regexp_extract("prompt", r"(?s)(\{\"source.*\})$", 1), "$.raw_text_trad") == F.col("raw_text_trad")
    return jobs.select("passage_id", "task_code", has('"distractors"').alias("choice"), has(M.DIFFICULTY["Expert"]).alias("levelled"), text.alias("holds_text"))


REPLY = """CASE passage_idx % 7
  WHEN 0 THEN 'Here: {"question": "問", "answer": "答附子", "evidence_spans": ["' || substr(book_id, 1, 3) || '", "乙"]} done'
  WHEN 1 THEN 'nothing to say'
  WHEN 2 THEN '{"answer": "甲", "evidence": "單", "options": ["甲", "乙", "丙"], "inference_level": "implicit"}'
  WHEN 3 THEN '{"question": "無答"}'
  WHEN 4 THEN '{"answer": "烏頭", "safety_note": "已注", "difficulty": "Expert", "context": "境"}'
  WHEN 5 THEN NULL
  ELSE '{"answer": "broken' END"""
REPLIES = JOBS + f""", replies AS (SELECT j.passage_id, j.task_code, c.book_id, c.raw_text_trad, {REPLY.replace("passage_idx", "c.passage_idx").replace("book_id", "c.book_id")} AS reply, CASE WHEN c.passage_idx % 7 = 5 THEN 'TimeoutError' END AS error
  FROM jobs j JOIN corpus c USING (passage_id)),
parsed AS (SELECT *, try_cast(nullif(regexp_extract(reply, '(?s)\\{{.*\\}}'), '') AS json) AS j FROM replies)"""


def replies(spark: SparkSession, sf: str, full: DataFrame | None = None) -> DataFrame:
    rows = jobs_and_done(spark, sf, full)[0]
    return rows.select("passage_id", "task_code", F.expr(REPLY).alias("reply"), F.when(F.col("passage_idx") % 7 == 5, "TimeoutError").alias("error"))


def _echo(system: str, prompt: str, max_tokens: int, temperature: float) -> str:
    if len(prompt) % 5 == 0:
        raise TimeoutError("busy")
    return f'{{"answer": "{len(prompt)}"}}'


@query("g06_model_calls", JOBS + """ SELECT passage_id, task_code, CASE WHEN n % 5 <> 0 THEN '{"answer": "' || n || '"}' END AS reply, CASE WHEN n % 5 = 0 THEN 'TimeoutError: busy' END AS error, cast(CASE WHEN n % 5 = 0 THEN 2 ELSE 1 END AS bigint) AS attempts
  FROM (SELECT passage_id, task_code, len(raw_text_trad || task_code) AS n FROM jobs JOIN corpus USING (passage_id))""")
def g06(spark, sf):
    jobs = jobs_and_done(spark, sf)[0].withColumn("prompt", F.concat("raw_text_trad", "task_code"))
    return M.complete(jobs, _echo, 4, 3, max_retries=1, pause=0.0)


def _refuse(system: str, prompt: str, max_tokens: int, temperature: float) -> str:
    raise RuntimeError("asked again")


@query("g06_ledger", JOBS + """ SELECT passage_id, task_code, CASE WHEN n % 5 <> 0 THEN '{"answer": "' || n || '"}' END AS reply, CASE WHEN n % 5 = 0 THEN 'RuntimeError: asked again' END AS error, cast(1 AS bigint) AS attempts
  FROM (SELECT passage_id, task_code, len(raw_text_trad || task_code) AS n FROM jobs JOIN corpus USING (passage_id))""")
def g06_ledger(spark, sf):
    """All jobs twice: what the first run has paid for comes from the ledger, the rest is asked again."""
    jobs = stored(jobs_and_done(spark, sf)[0].select("passage_id", "task_code", F.concat("raw_text_trad", "task_code").alias("prompt")), "jobs")
    ledger = scratch_path(spark, "ledger")
    M.complete(jobs, _echo, 4, 3, ledger=ledger, max_retries=0, pause=0.0).write.format("noop").mode("overwrite").save()
    return M.complete(jobs, _refuse, 4, 3, ledger=ledger, max_retries=0, pause=0.0)


@query("g07_items_from_replies", REPLIES + f""" SELECT book_id || '::' || task_code || '::' || substr(sha1(passage_id || '|' || task_code || '|m1'), 1, 10) AS item_id, task_code, coalesce(j->>'question', '') AS question,
  coalesce(nullif(j->>'context', ''), raw_text_trad) AS context, coalesce(j->>'answer', NULL) AS answer_text, coalesce(j->>'inference_level', 'direct') AS inference_level, coalesce(j->>'difficulty', 'Hard') AS difficulty,
  coalesce(array_to_string(cast(j->'options' AS varchar[]), ';'), '') AS options, CASE WHEN j->>'evidence' IS NOT NULL THEN j->>'evidence' ELSE coalesce(array_to_string(cast(j->'evidence_spans' AS varchar[]), ';'), '') END AS spans,
  CASE WHEN coalesce(j->>'safety_note', '') <> '' THEN j->>'safety_note' WHEN {Q.restricted("coalesce(j->>'answer', '')")} THEN {Q.q(Q.SAFETY_NOTE)} ELSE '' END AS safety_note FROM parsed WHERE j IS NOT NULL""")
def g07(spark, sf):
    full = corpus_(spark, sf)
    found = M.items_from_replies(replies(spark, sf, full), full, "m1")
    return found.select("item_id", "task_code", "question", "context", "answer_text", "inference_level", "difficulty", F.array_join("options", ";").alias("options"), F.array_join("evidence.spans", ";").alias("spans"), "safety_note")


@query("g08_job_accounting", REPLIES + " SELECT count(*) AS jobs_total, count(error) AS errored, count(*) FILTER (error IS NULL AND j IS NULL) AS parse_failed, count(*) FILTER (error IS NULL AND j IS NOT NULL) AS yielded FROM parsed")
def g08(spark, sf):
    return M.job_accounting(replies(spark, sf))


# ---------------------------------------------------------------- joins
@query("j01_items_with_source", "SELECT item_id, CASE WHEN len(raw_text_trad) < 40 THEN '' ELSE raw_text_trad END AS source_text FROM items")
def j01(spark, sf):
    full = corpus_(spark, sf)
    return V.with_source(G.generate_items(full, ["T1", "T6"]), C.min_length(full, 40)).select("item_id", "source_text")


@query("j01_bucketed_validation", "SELECT item_id, len(errors) = 0 AS ok, array_to_string(errors, ';') AS errors FROM checked")
def j01b(spark, sf):
    """Stored items against stored passages, both bucketed by passage: the join shuffles nothing."""
    full = stored_by(D.corpus(spark, sf), "corpus", "passage_id", 8)
    made = stored_by(broken(full).drop("source_text", "source_normalized"), "items", "passage_id", 8)
    return V.validate_stored(made, full).select("item_id", "ok", F.array_join("errors", ";").alias("errors"))


@query("j02_passages_with_books", "SELECT passage_id, book_title_trad, author, dynasty, quality_score_source FROM corpus_all")
def j02(spark, sf):
    return D.corpus(spark, sf, 0).select("passage_id", "book_title_trad", "author", "dynasty", "quality_score_source")


@query("j03_resume", JOBS + " SELECT passage_id, task_code FROM jobs WHERE (passage_id, task_code) NOT IN (SELECT (passage_id, task_code) FROM done)")
def j03(spark, sf):
    jobs, done = jobs_and_done(spark, sf)
    return G.resume(jobs, done).select("passage_id", "task_code")


SAMPLE = ", sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY CASE WHEN n_formulas = 0 THEN 1 ELSE 0 END, passage_idx) AS rn FROM corpus) WHERE rn <= 30)"
CAPPED = ", capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_code, book_id ORDER BY passage_idx, task_rank, formula_no) AS rn FROM items) WHERE rn <= 25)"
ITEM_ORDER = ["passage_idx", "task_rank", "formula_no"]


@query("j04_release_corpus", SAMPLE + CAPPED + " SELECT passage_id FROM corpus WHERE passage_id IN (SELECT passage_id FROM sampled) OR passage_id IN (SELECT passage_id FROM capped)")
def j04(spark, sf):
    c = corpus_(spark, sf)
    capped = R.cap_items(G.generate_items(c, ["T1", "T6"], carry=("passage_idx",)), 25, ITEM_ORDER)
    return R.release_corpus(c, R.balanced_sample(c, 30), capped).select("passage_id")


@query("j05_menu_files", "SELECT book_id, file_name, file_ord AS pos FROM ordered WHERE book_id IN (SELECT book_id FROM listed)")
def j05(spark, sf):
    files = D.files(spark, sf)
    return S.file_order(files).join(files.where("file_name = 'menu.txt'").select("book_id"), "book_id", "left_semi").select("book_id", "file_name", F.col("file_ord").cast("long").alias("pos"))


# ---------------------------------------------------------------- validation
def broken(c: DataFrame) -> DataFrame:
    """Items of which eight in nine rows are broken, each in one way, by passage number."""
    rows = G.generate_items(c.withColumns({"source_text": F.col("raw_text_trad"), "source_normalized": F.col("normalized_text")}), ["T1", "T6"], carry=("passage_idx", "source_text", "source_normalized"))
    k = F.col("passage_idx") % 9
    strings = lambda *xs: F.array(*map(F.lit, xs)).cast("array<string>")
    extra = F.struct(F.lit("虛構藥").alias("herb"), F.lit("九萬兩").alias("dose"), F.lit(None).cast("string").alias("preparation"), F.lit(None).cast("string").alias("evidence"))
    two = F.array(
        F.struct(F.lit("乙").alias("option"), F.lit("").alias("exclusion_reason"), F.lit(False).alias("requires_external")),
        F.struct(F.lit("丙").alias("option"), F.lit("無據").alias("exclusion_reason"), F.lit(True).alias("requires_external")),
    )
    e = F.col("evidence")
    e = e.withField("spans", F.when(k == 0, F.concat(e["spans"], strings("不存在之文", ""))).otherwise(e["spans"]))
    e = e.withField("book_title_trad", F.when(k == 3, "").otherwise(e["book_title_trad"])).withField("source_id", F.when(k == 2, "other").otherwise(F.lit(SOURCE_ID)))
    f = F.col("answer_formula")
    return rows.withColumns(
        {
            "evidence": e,
            "context": F.when(k == 4, F.concat("context", F.lit("贅"))).otherwise(F.col("context")),
            "safety_note": F.when(k == 7, "").otherwise(F.col("safety_note")),
            "answer_formula": F.when((k == 6) & f.isNotNull(), f.withField("ingredients", F.concat(f["ingredients"], F.array(extra)))).otherwise(f),
            "inference_level": F.when(k == 1, "external_required").otherwise("direct"),
            "options": F.when(k == 5, strings("甲", "乙")).when(k == 8, strings("甲", "乙", "丙", "丁")).otherwise(strings()),
            "distractors": F.when((k == 8) | (F.col("passage_idx") % 18 == 5), two).otherwise(F.array().cast(G.DISTRACTORS)),
        }
    )


def check(name: str, errors: Callable[[], Column], oracle: str) -> None:
    query(name, f"SELECT item_id, array_to_string({oracle}, ';') AS found FROM checks2")(lambda s, sf: broken(D.corpus(s, sf)).select("item_id", F.array_join(errors(), ";").alias("found")))


check("v01_provenance", V.provenance_errors, "e_provenance")
check("v02_spans", V.span_errors, "e_spans")
check("v03_level", V.level_errors, "e_level")
check("v04_formula", V.formula_errors, "e_formula")
check("v05_punctuation", V.punctuation_errors, "e_marks")
check("v06_mcq_shape", lambda: F.concat(V.mcq_errors(), V.mcq_warnings()), "list_concat(e_mcq, w_mcq)")
check("v07_safety", V.safety_warnings, "w_safety")


@query("v08_validate", "SELECT item_id, len(errors) = 0 AS ok, array_to_string(errors, ';') AS errors, array_to_string(warnings, ';') AS warnings FROM checked")
def v08(spark, sf):
    return V.validate(broken(D.corpus(spark, sf))).select("item_id", "ok", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"))


@query("v09_validate_mcq", "SELECT item_id, len(errors) + len(e_distractors) = 0 AS ok, array_to_string(list_concat(errors, e_distractors), ';') AS errors, array_to_string(list_concat(warnings, w_distractors), ';') AS warnings FROM checked")
def v09(spark, sf):
    return V.validate_mcq(broken(D.corpus(spark, sf))).select("item_id", "ok", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"))


ANSWERS = """CASE passage_idx % 12 WHEN 0 THEN '""' WHEN 1 THEN '[]' WHEN 2 THEN '{}' WHEN 3 THEN 'null' WHEN 4 THEN '0' WHEN 5 THEN 'false' WHEN 6 THEN '"甲"' WHEN 7 THEN '["甲"]' WHEN 8 THEN '{"x": "甲"}' WHEN 9 THEN '7' WHEN 10 THEN '0.0' ELSE 'true' END"""
CHOICE = f"""'{{"question": "問", "options": ["甲", "乙", "丙"], "evidence_spans": [null, "' || CASE passage_idx % 5 WHEN 0 THEN '無此文字' ELSE '' END || '"], "answer": ' || {ANSWERS} || '}}'"""


@query("v06_model_answers", JOBS + """ SELECT passage_id, task_code, passage_idx % 12 IN (6, 7, 8, 9, 11) AND passage_idx % 5 <> 0 AS ok,
  concat_ws(';', CASE WHEN passage_idx % 5 = 0 THEN 'span:無此文字' END, CASE WHEN passage_idx % 12 NOT IN (6, 7, 8, 9, 11) THEN 'mcq_without_answer' END) AS errors FROM jobs""")
def v06m(spark, sf):
    full = stored(D.corpus(spark, sf), "corpus")
    said = G.model_jobs(full, ALL_TASKS).select("passage_id", "task_code", F.expr(CHOICE).alias("reply"))
    rows = full.withColumns({"source_text": F.col("raw_text_trad"), "source_normalized": F.col("normalized_text")})
    found = V.validate(M.items_from_replies(said, rows, "m1", carry=("source_text", "source_normalized")))
    return found.select("passage_id", "task_code", "ok", F.array_join("errors", ";").alias("errors"))


FORMULA = """'{"question": "問", "evidence_spans": [], "task": "formula_structure_parsing", "answer": {"formula_name": "' || CASE passage_idx % 5 WHEN 0 THEN '虛構湯' ELSE substr(book_id, 1, 0) END || '", "ingredients": [{"herb": "' || CASE passage_idx % 5 WHEN 1 THEN '無此藥' ELSE '' END || '", "dose": ' || CASE passage_idx % 5 WHEN 2 THEN '"九萬兩"' ELSE 'null' END || '}, {"herb": "' || CASE WHEN passage_idx % 5 = 3 THEN '又無' ELSE '' END || '"' || CASE WHEN passage_idx % 5 = 3 THEN ', "dose": "十噸"' ELSE '' END || '}]}}'"""


@query("v04_model_formulas", JOBS + """ SELECT passage_id, task_code, passage_idx % 5 = 4 AS ok, CASE passage_idx % 5 WHEN 0 THEN 'name:虛構湯' WHEN 1 THEN 'herb:無此藥' WHEN 2 THEN 'dose:九萬兩' WHEN 3 THEN 'herb:又無;dose:十噸' ELSE '' END AS errors FROM jobs""")
def v04m(spark, sf):
    """Formulas that a model has made up, in the answer's JSON."""
    full = stored(D.corpus(spark, sf), "corpus")
    said = G.model_jobs(full, ALL_TASKS).select("passage_id", "task_code", F.expr(FORMULA).alias("reply"))
    found = J.judged(full, said, "m1")
    return found.select("passage_id", "task_code", "ok", F.array_join("errors", ";").alias("errors"))


# ---------------------------------------------------------------- samples


@query("r01_balanced_take", ", pos AS (SELECT *, row_number() OVER (ORDER BY book_id, passage_idx, task_rank, formula_no) AS p FROM items), ranked AS (SELECT *, row_number() OVER (PARTITION BY task_code, book_id ORDER BY p) AS rn, min(p) OVER (PARTITION BY task_code, book_id) AS f FROM pos) SELECT item_id FROM (SELECT * FROM ranked ORDER BY rn, f LIMIT 500)")
def r01(spark, sf):
    return R.balanced_take(items(spark, sf, ("passage_idx",)), 500, ["book_id", *ITEM_ORDER]).select("item_id")


@query("r02_balanced_sample", SAMPLE + " SELECT passage_id, n_formulas FROM sampled")
def r02(spark, sf):
    return R.balanced_sample(D.corpus(spark, sf), 30).select("passage_id", F.size("formulas").alias("n_formulas"))


@query("r03_cap_items", CAPPED + " SELECT item_id, task_code, book_id FROM capped")
def r03(spark, sf):
    return R.cap_items(items(spark, sf, ("passage_idx",)), 25, ITEM_ORDER).select("item_id", "task_code", "book_id")


@query("r04_shuffle_order", "SELECT passage_id, row_number() OVER (PARTITION BY book_id ORDER BY sha256('7:' || passage_id)) AS place FROM corpus")
def r04(spark, sf):
    from pyspark.sql import Window

    key = R.shuffle_key(7, F.col("passage_id"))
    return D.corpus(spark, sf).select("passage_id", F.row_number().over(Window.partitionBy("book_id").orderBy(key)).alias("place"))


@query("r05_stop_at_n", "SELECT passage_id FROM (SELECT passage_id FROM corpus ORDER BY sha256('3:' || passage_id) LIMIT 60)")
def r05(spark, sf):
    rows = stored(D.corpus(spark, sf).withColumn("shuffle", R.shuffle_key(3, F.col("passage_id"))), "corpus")
    return R.first_n(rows, ["shuffle", "passage_id"], 100, already=40).select("passage_id")


@query("r06_top_reasons", "SELECT errors[1] AS reason, count(*) AS n FROM checked WHERE len(errors) > 0 GROUP BY 1 ORDER BY n DESC, reason LIMIT 5")
def r06(spark, sf):
    return R.top_reasons(V.validate(broken(D.corpus(spark, sf))), 5)


@query("r07_pilot_union", "SELECT pilot, book_id, passage_idx, row_number() OVER (PARTITION BY pilot ORDER BY book_ord, passage_idx) AS place FROM pcorpus")
def r07(spark, sf):
    from pyspark.sql import Window

    return D.pilot_corpus(spark, sf).select("pilot", "book_id", "passage_idx", F.row_number().over(Window.partitionBy("pilot").orderBy("book_ord", "passage_idx")).alias("place"))


# ---------------------------------------------------------------- reports
def _release(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return J.release(D.files(spark, sf), C.pilot_table(spark, D.PILOTS), D.DATE, full=D.pilot_corpus(spark, sf))


PSTATS = SAMPLE.replace("FROM corpus", "FROM pcorpus") + CAPPED.replace("FROM items", "FROM pitems") + """, st AS (SELECT pilot, count(*) AS passages_full, count(*) FILTER (n_formulas > 0) AS formula_passages,
  count(*) FILTER (passage_id IN (SELECT passage_id FROM sampled) OR passage_id IN (SELECT passage_id FROM capped)) AS passages_sampled FROM pcorpus GROUP BY pilot)"""


@query("a01_pilot_stats", PSTATS + """ SELECT st.pilot, passages_full, formula_passages, passages_sampled, (SELECT count(*) FROM pitems i WHERE i.pilot = st.pilot) AS items_generated,
  (SELECT count(*) FROM pitems i WHERE i.pilot = st.pilot) AS items_valid, cast(0 AS bigint) AS items_failed, (SELECT count(*) FROM capped i WHERE i.pilot = st.pilot) AS items_released FROM st""")
def a01(spark, sf):
    return _release(spark, sf)["stats"]


@query("a02_items_per_task", "SELECT pilot, task_code, count(*) AS n FROM pitems GROUP BY ALL")
def a02(spark, sf):
    return A.task_map(G.generate_items(D.pilot_corpus(spark, sf), ["T1", "T6"], carry=("pilot",)), "pilot").select("pilot", F.explode("by_task").alias("task_code", "n"))


@query("a03_catalog_counts", "SELECT 'category_level_1' AS dimension, category_level_1 AS value, count(*) AS n FROM catalog GROUP BY 2 UNION ALL SELECT 'quality_tier', quality_tier, count(*) FROM catalog GROUP BY 2")
def a03(spark, sf):
    return A.grouped_counts(S.catalog(D.files(spark, sf)), "category_level_1", "quality_tier")


@query("a04_item_counts", "SELECT 'task_code' AS dimension, task_code AS value, count(*) AS n FROM items GROUP BY 2 UNION ALL SELECT 'book_id', book_id, count(*) FROM items GROUP BY 2")
def a04(spark, sf):
    return A.grouped_counts(items(spark, sf), "task_code", "book_id")


@query("a05_books_covered", "SELECT count(DISTINCT book_id) AS books FROM items")
def a05(spark, sf):
    return A.books_covered(items(spark, sf))


@query("a06_validation_totals", "SELECT count(*) FILTER (len(errors) = 0) AS ok, count(*) FILTER (len(errors) > 0) AS failed FROM checked")
def a06(spark, sf):
    return A.validation_totals(V.validate(broken(D.corpus(spark, sf))))


@query("a07_rejected_by_level", "SELECT inference_level, count(*) AS n FROM checked WHERE len(errors) > 0 GROUP BY 1")
def a07(spark, sf):
    return A.rejected_by_level(V.validate(broken(D.corpus(spark, sf))))


@query("a08_totals", "SELECT pilot, count(*) AS items_generated, cast(0 AS bigint) AS items_failed FROM pitems GROUP BY ROLLUP (pilot)")
def a08(spark, sf):
    return _release(spark, sf)["totals"]


@query("a09_run_report", REPLIES + """ SELECT cast(40 AS bigint) AS target, count(*) AS jobs_total, count(error) AS errored, count(*) FILTER (error IS NULL AND j IS NULL) AS parse_failed, count(*) FILTER (error IS NULL AND j IS NOT NULL) AS yielded,
  (SELECT count(*) FILTER (len(errors) = 0) FROM checked) AS accepted, (SELECT count(*) FILTER (len(errors) > 0) FROM checked) AS rejected, greatest(0, 40 - (SELECT count(*) FILTER (len(errors) = 0) FROM checked)) AS shortfall FROM parsed""")
def a09(spark, sf):
    full = corpus_(spark, sf)
    return A.run_report(replies(spark, sf, full), V.validate(broken(full)), 40)


# ---------------------------------------------------------------- further uses and jobs
@query("d01_deduplicate", "SELECT passage_id FROM (SELECT passage_id, row_number() OVER (PARTITION BY normalized_text ORDER BY book_id, passage_idx) AS rn FROM corpus) WHERE rn = 1")
def d01(spark, sf):
    return C.deduplicate(D.corpus(spark, sf)).select("passage_id")


@query("d02_stratified_sample", "SELECT passage_id, category_level_1 FROM (SELECT *, row_number() OVER (PARTITION BY category_level_1 ORDER BY sha256('5:' || passage_id)) AS rn FROM corpus) WHERE rn <= 20")
def d02(spark, sf):
    return R.stratified_sample(D.corpus(spark, sf), "category_level_1", 20, 5).select("passage_id", "category_level_1")


@query("d03_trace_spans", f"""SELECT DISTINCT span_id, passage_id FROM (SELECT span_id, {Q.normalize('span')} AS n FROM (SELECT item_id || ':' || i AS span_id, p[i] AS span FROM
  (SELECT item_id, string_split(text, '.') AS p, unnest(range(1, len(string_split(text, '.')) + 1)) AS i FROM benchmark))) b JOIN corpus c ON n <> '' AND contains(normalized_text, n)""")
def d03(spark, sf):
    sentences = D.table(spark, sf, "benchmark").select("item_id", F.posexplode(F.split("text", "[.]", -1)).alias("i", "span"))
    spans = sentences.select(F.concat_ws(":", "item_id", F.col("i") + 1).alias("span_id"), "span")
    return C.trace_spans(spans, stored(D.corpus(spark, sf), "corpus"))


@query("job_simple", ", ok AS (SELECT *, sha256('11:' || passage_id) AS k FROM pitems WHERE len(raw_text_trad) >= 20), pos AS (SELECT *, row_number() OVER (ORDER BY k, passage_id, task_rank, formula_no) AS p FROM ok), ranked AS (SELECT *, row_number() OVER (PARTITION BY task_code, book_id ORDER BY p) AS rn, min(p) OVER (PARTITION BY task_code, book_id) AS f FROM pos) SELECT item_id FROM (SELECT * FROM ranked ORDER BY rn, f LIMIT 5000)")
def job_simple(spark, sf):
    return J.simple(D.pilot_corpus(spark, sf, 20), 5000, 11).select("item_id")


@query("job_release_items", CAPPED.replace("FROM items", "FROM pitems") + " SELECT pilot, item_id, task_code FROM capped")
def job_release(spark, sf):
    return _release(spark, sf)["items"].select("pilot", "item_id", "task_code")


@query("st1_streamed_items", "SELECT item_id, task_code FROM items")
def st1(spark, sf):
    from ..streaming.items import stream_items, write_items

    base = scratch_path(spark, "stream")
    c = D.corpus(spark, sf)
    c.write.parquet(f"{base}/corpus")
    schema = spark.read.parquet(f"{base}/corpus").schema
    write_items(stream_items(spark, f"{base}/corpus", schema, ["T1", "T6"]), f"{base}/items", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/items").select("item_id", "task_code")


@query("st2_streamed_resume", "SELECT item_id, task_code FROM items")
def st2(spark, sf):
    from ..streaming.items import stream_items, write_new_items

    base = scratch_path(spark, "stream")
    c = D.corpus(spark, sf)
    c.write.parquet(f"{base}/corpus")
    schema = spark.read.parquet(f"{base}/corpus").schema
    for k in range(2):  # the second run, on a state of its own, finds all done
        write_new_items(stream_items(spark, f"{base}/corpus", schema, ["T1", "T6"], 4), f"{base}/items", f"{base}/state{k}").awaitTermination()
    return spark.read.parquet(f"{base}/items").select("item_id", "task_code")


def _answer(system: str, prompt: str, max_tokens: int, temperature: float) -> str:
    return '{"question": "q", "answer": "a"}'


@query("st3_model_waves", JOBS + " SELECT passage_id, task_code, 'T' || wave AS wave FROM (SELECT passage_id, task_code, 1 + (row_number() OVER (ORDER BY sha256('0:' || passage_id || '|' || task_code)) - 1) // greatest(1, cast(ceil(count(*) OVER () / 3) AS bigint)) AS wave FROM jobs)")
def st3(spark, sf):
    """All jobs in three waves, each as large as a third of them."""
    full = stored(D.corpus(spark, sf), "corpus")
    waves = J.model_waves(full, ALL_TASKS, _answer, "m1", 3, 4, store=lambda df: stored(df, "replies"), pause=0.0)
    return J.union(replies.select("passage_id", "task_code", F.lit(f"T{n}").alias("wave")) for n, (replies, _) in enumerate(waves, 1))


def _moody(system: str, prompt: str, max_tokens: int, temperature: float) -> str:
    """By the passage's length: an error, no object, a span that the passage lacks, or a good answer."""
    import json

    text = json.loads(prompt[prompt.index('{"source"') :])["raw_text_trad"]
    if len(text) % 5 == 0:
        raise TimeoutError("busy")
    return {1: "nothing", 2: '{"answer": "甲", "evidence": "無此文字"}'}.get(len(text) % 5, json.dumps({"answer": "甲", "evidence": text[:4]}))


@query("st3_target_run", JOBS + """, given AS (SELECT * FROM jobs WHERE substr(sha1(passage_id || task_code), 1, 1) = '0'),
  good AS (SELECT passage_id, task_code, row_number() OVER (ORDER BY sha256('0:' || passage_id || '|' || task_code)) AS place FROM jobs JOIN corpus USING (passage_id)
    WHERE len(raw_text_trad) % 5 > 2 AND (passage_id, task_code) NOT IN (SELECT (passage_id, task_code) FROM given))
  SELECT passage_id, task_code FROM good WHERE place <= (SELECT count(*) // 4 FROM jobs) - (SELECT count(*) FROM given)""")
def st3t(spark, sf):
    """Waves until a quarter of all jobs is accepted, a sixteenth of them given as done; some calls always fail."""
    full = stored(D.corpus(spark, sf), "corpus")
    jobs = stored(G.model_jobs(full, ALL_TASKS).select("passage_id", "task_code"), "jobs")
    given = jobs.where(F.substring(F.sha1(F.concat("passage_id", "task_code")), 1, 1) == "0")
    run = J.ModelRun(full, ALL_TASKS, _moody, "m1", scratch_path(spark, "model-run"), 4, 4, done=given, max_retries=0, pause=0.0)
    return run.run(jobs.count() // 4).select("passage_id", "task_code")


@query("st2_keyed_state", "SELECT item_id, task_code FROM items")
def st2k(spark, sf):
    """Two runs on one state; the second finds all passages again and reads no sink."""
    from ..streaming.items import stream_keyed_items, write_keyed_items

    base = scratch_path(spark, "stream")
    c = stored(D.corpus(spark, sf), "corpus")
    for _ in range(2):
        c.write.mode("append").parquet(f"{base}/corpus")
        write_keyed_items(stream_keyed_items(spark, f"{base}/corpus", c.schema, ["T1", "T6"], max_files=4), f"{base}/items", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/items").select("item_id", "task_code")
