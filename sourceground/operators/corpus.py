"""The corpus table: passages with their book's metadata, filters, traces of spans."""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions import text as X
from ..functions.lookups import (
    CORPUS_VERSION,
    FORMAL_TIER,
    PILOTS,
    SOURCE_HOMEPAGE,
    SOURCE_ID,
    SOURCE_LICENSE,
)
from ..sources.books import book_pieces, catalog
from ..sources.scratch import sent_if_small, stored
from .passages import passages_of


def corpus_records(found: DataFrame, books: DataFrame, ingestion_date: str, version: str = CORPUS_VERSION, simplified: dict[str, str] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Passages joined with the catalog (one small row per book, stored and sent to them) and enriched. ``carry`` keeps further columns of the catalog."""
    path, text = F.col("heading_path"), F.col("text")
    columns = ["book_title_trad", "book_title_simp", "author", "dynasty", "year", "category_level_1", "category_level_2", "base_text", "quality_score_source", "quality_tier", "source_url"]
    books = stored(books.select("book_id", *columns, *carry), "catalog")
    joined = found.join(sent_if_small(books, 1000), "book_id")
    return joined.select(
        X.passage_id(F.col("book_id"), path, text, F.col("passage_idx")).alias("passage_id"),
        "book_id", *columns[:10], "heading_path",
        F.get(path, F.lit(0)).alias("chapter"),
        F.get(path, F.lit(1)).alias("section_title"),
        text.alias("raw_text_trad"),
        X.to_simplified(text, simplified).alias("raw_text_simp"),
        X.normalize(text).alias("normalized_text"),
        "formulas",
        classify.candidate_tasks(F.col("category_level_1")).alias("candidate_tasks"),
        F.lit("source_punctuated").alias("punctuation_status"),
        F.lit(SOURCE_ID).alias("source_id"),
        "source_url",
        F.lit(SOURCE_LICENSE).alias("source_license"),
        F.lit(version).alias("version_commit"),
        F.lit(ingestion_date).alias("ingestion_date"),
        "passage_idx", *carry,
    )


def min_length(corpus: DataFrame, min_chars: int = 12, column: str = "raw_text_trad") -> DataFrame:
    """Passages of at least so many code points; their numbers were given before."""
    return corpus.where(F.length(column) >= min_chars)


def ingest(files: DataFrame, ingestion_date: str, min_chars: int = 12, homepage: str = SOURCE_HOMEPAGE, simplified: dict[str, str] | None = None, pilots: DataFrame | None = None) -> DataFrame:
    """Book files to corpus records; with ``pilots``, as ``select_pilots`` of them. The lists meet the catalog, not the passages."""
    books = catalog(files, homepage, simplified)
    carry = () if pilots is None else ("pilot", "pilot_ord", "book_ord")
    books = books if pilots is None else select_pilots(books, pilots)
    return min_length(corpus_records(passages_of(book_pieces(files)), books, ingestion_date, simplified=simplified, carry=carry), min_chars)


def pilot_table(spark, pilots: dict[str, list[str]] | None = None) -> DataFrame:
    """(pilot, pilot_ord, book_id, book_ord) of the listed corpora; a list in the code, hence small."""
    pilots = PILOTS if pilots is None else pilots
    rows = [(p, i, b, j) for i, (p, books) in enumerate(pilots.items()) for j, b in enumerate(books)]
    listed = F.array(*(F.struct(*map(F.lit, row)) for row in rows)).cast("array<struct<pilot:string,pilot_ord:int,book_id:string,book_ord:int>>")
    return spark.range(1).select(F.inline(listed))  # of constants: no Python worker starts for it


def listed(files: DataFrame, pilots: DataFrame) -> DataFrame:
    """The files of listed books."""
    return files.join(F.broadcast(pilots.select("book_id")), "book_id", "left_semi")


def select_pilots(df: DataFrame, pilots: DataFrame) -> DataFrame:
    """Rows of the listed books, once for each list that names them, with the lists' order columns."""
    return df.join(F.broadcast(pilots), "book_id")


def routed_tasks(corpus: DataFrame, tasks: list[str]) -> DataFrame:
    """A row for each requested task that a passage can serve."""
    wanted = F.array(*map(F.lit, tasks)).cast("array<string>")
    return corpus.select("*", F.explode(F.array_intersect("candidate_tasks", wanted)).alias("task_code"))


def formal_pool(items: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """Items without outside knowledge; with a corpus, only those of passages in the test tier."""
    kept = items.where(F.col("inference_level") != "external_required")
    if corpus is not None:
        kept = kept.join(corpus.where(F.col("quality_tier") == FORMAL_TIER).select("passage_id"), "passage_id", "left_semi")
    return kept


def deduplicate(corpus: DataFrame) -> DataFrame:
    """One passage for each normalised text: the first by book and number."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy("__key").orderBy("book_id", "passage_idx"))
    return corpus.withColumn("__key", F.sha2("normalized_text", 256)).withColumn("__rn", first).where("__rn = 1").drop("__key", "__rn")


#: Bytes of normalised spans in one automaton.
SPAN_BYTES = 4 << 20


def _matcher(table: pa.Table):
    """An Aho-Corasick automaton over the spans of ``table`` (n, span_id); a word's value is the list of its rows."""
    import ahocorasick

    rows: dict[str, list[int]] = {}
    for at, word in enumerate(table.column("n").to_pylist()):
        rows.setdefault(word, []).append(at)
    automaton = ahocorasick.Automaton()
    for word, held in rows.items():
        automaton.add_word(word, held)
    automaton.make_automaton()
    return automaton


def trace_spans(spans: DataFrame, corpus: DataFrame, most_bytes: int = SPAN_BYTES) -> DataFrame:
    """(span_id, passage_id) of all passages that hold a span in their normalised text.

    Spans are sent to the passages in groups of about ``most_bytes`` bytes, each as one
    Aho-Corasick automaton that a task builds once and runs over its Arrow batches: a passage
    is read once for each group, and no text is shuffled. Null and empty spans are in none.
    """
    normal = spans.select("span_id", X.normalize(F.col("span")).alias("n")).where("n <> ''").distinct()
    normal = stored(normal, "spans")
    size = normal.agg(F.sum(F.octet_length("n") + 16)).first()[0] or 0
    groups = max(1, -(-size // most_bytes))
    id_type = spans.schema["span_id"].dataType.simpleString()
    dealt = F.pmod(F.xxhash64("n"), F.lit(groups))

    def hits(group: int) -> DataFrame:
        table = normal.where(dealt == group).select("n", "span_id").toArrow()  # one group
        sent = corpus.sparkSession.sparkContext.broadcast(table)

        def run(batches):
            own = sent.value
            automaton = _matcher(own) if own.num_rows else None
            ids = own.column("span_id").combine_chunks()
            for batch in batches:
                at, whose = [], []
                for row, text in enumerate(batch.column("normalized_text").to_pylist() if automaton else ()):
                    found = {k for _, held in automaton.iter(text or "") for k in held}
                    at.extend(found)
                    whose.extend([row] * len(found))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), batch.column("passage_id").take(pa.array(whose, pa.int64()))], names=["span_id", "passage_id"])

        return corpus.select("passage_id", "normalized_text").mapInArrow(run, f"span_id {id_type}, passage_id string")

    return functools.reduce(DataFrame.union, [hits(g) for g in range(groups)]).distinct()
