"""Book files made from the driver's documents, by one recipe that Spark and DuckDB both run.

Each source is a book and each document a file: a heading, the text with Chinese marks and
a blank line after each sentence, and for some a formula block. Books have metadata, some
have a menu, one is only an index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators.passages import passages_of
from ..sources import books
from ..sources.scratch import stored

DATE = "2026-01-01"
PILOTS = {"p1": ["src0", "src1", "src2", "absent"], "p2": ["src3", "src4", "src5", "src6", "src7"], "p3": ["src8", "src9", "src10", "src11"]}

NL = "chr(10)"
HEADING = "repeat('=', cast(3 + doc_id % 4 AS int))"
HERBS = (
    "'<F>' || chr(10) || '**試方' || cast(doc_id % 13 AS string) || '湯方：**' || chr(10) || chr(10) || "
    "CASE WHEN doc_id = 15 THEN '=== 塊內題 ===' || chr(10) ELSE '' END || "
    "'人參<l>三兩，去蘆</l>' || CASE WHEN doc_id % 2 = 0 THEN '附子' ELSE '生薑' END || '<l> ' || cast(doc_id % 7 + 1 AS string) || '枚 </l>　　甘草<l></l>' || chr(10) || "
    "'右三味，((一本作煮))水煎服。見[[book:src' || cast(doc_id % 20 AS string) || ':]]。'"
)
FILES = f"""
SELECT source AS book_id, cast(doc_id AS string) || '.txt' AS file_name,
  {HEADING} || ' 卷' || cast(doc_id % 9 AS string) || ' ' || {HEADING} || {NL}
  || replace(replace(replace(text, '.' || {NL}, '。' || {NL} || {NL}), '. ', '。' || {NL} || {NL}), ', ', '，') || {NL} || {NL}
  || CASE WHEN doc_id % 5 = 0 THEN {HERBS} || CASE WHEN doc_id = 45 THEN '' ELSE {NL} || '</F>' || {NL} END ELSE '' END AS content
FROM documents WHERE text IS NOT NULL AND source IS NOT NULL
UNION ALL
SELECT source, 'index.txt', '====== 書名' || source || ' ======' || {NL} || '<book>' || {NL} || '書名=書' || source || {NL} || '作者=某=人' || {NL} || '分類='
  || CASE n % 6 WHEN 0 THEN '傷寒 金匱' WHEN 1 THEN '本草' WHEN 2 THEN '未知' WHEN 3 THEN '' WHEN 4 THEN '醫方' ELSE '內科 外科' END || {NL}
  || CASE n % 6 WHEN 0 THEN '品質=90%' WHEN 1 THEN '品質=65%' WHEN 2 THEN '品質=20%' WHEN 3 THEN '品質=0%' WHEN 4 THEN '說明=無' ELSE '品質=x' END || {NL}
  || CASE WHEN n % 3 = 0 THEN '參本=' || {NL} || '底本=底' || source WHEN n % 3 = 1 THEN '版本=' ELSE '版本=甲' || {NL} || '版本=乙' END || {NL} || '</book>' || {NL} || '末行無用'
FROM (SELECT source, cast(substr(source, 4) AS int) AS n FROM documents WHERE source LIKE 'src%' GROUP BY source) AS s
UNION ALL
SELECT source, 'menu.txt', '<menu>' || {NL} || cast(max(doc_id) AS string) || '|末卷' || {NL} || cast(min(doc_id) AS string) || '|首卷' || {NL} || '999999999|缺卷' || {NL} || '</menu>'
FROM documents WHERE length(source) = 5 GROUP BY source
UNION ALL
SELECT 'solo', 'index.txt', '<book>' || {NL} || '朝代=清' || {NL} || '</book>' || {NL} || '=== 獨卷 ===' || {NL} || '僅此一段文字，共有 ' || cast(count(*) AS string) || ' 篇。' || {NL} || {NL} || '<F>' || {NL} || '**散**' || {NL} || {NL} || '未完' FROM documents
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str, pilots: DataFrame | None = None) -> DataFrame:
    """With ``pilots`` the files of listed books: documents of other books are dropped before their text is rewritten."""
    documents = table(spark, sf_dir, "documents")
    if pilots is not None:
        documents = C.listed(documents.withColumn("book_id", F.col("source")), pilots).drop("book_id")
    found = spark.sql(FILES.replace("FROM documents", "FROM {documents}"), documents=documents)
    return found if pilots is None else C.listed(found, pilots)  # one book is made of all documents


def source_files(spark: SparkSession, sf_dir: str, pilots: DataFrame | None = None) -> DataFrame:
    """The files that a reader would find (with ``pilots`` in the listed books), dealt to all tasks: a table in one file would be one task in each step that follows."""
    return stored(files(spark, sf_dir, pilots).repartition("book_id", "file_name"), "files")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books.book_lines(files(spark, sf_dir))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages_of(books.book_pieces(source_files(spark, sf_dir)))


def corpus(spark: SparkSession, sf_dir: str, min_chars: int = 12) -> DataFrame:
    return C.ingest(source_files(spark, sf_dir), DATE, min_chars)


def pilot_corpus(spark: SparkSession, sf_dir: str, min_chars: int = 12) -> DataFrame:
    pilots = C.pilot_table(spark, PILOTS)
    return C.ingest(source_files(spark, sf_dir, pilots), DATE, min_chars, pilots=pilots)
