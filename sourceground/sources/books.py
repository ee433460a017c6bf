"""Book folders: files, file order, metadata, catalog, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.lookups import META_KEYS, SOURCE_HOMEPAGE
from ..functions.text import LINE_END, book_url, let, strip, to_simplified
from .scratch import sent_if_small, stored


def folders(root: str) -> dict[str, str]:
    """What ``load`` needs to read the text files in the folders right below ``root``: the folders are listed, their files are not looked up one by one."""
    return {"path": f"{root}/*/", "pathGlobFilter": "*.txt"}


#: Tasks that read files, for each core. Spark opens at most 32 small files in a task, so many small files would be as many tasks and tables.
READERS = 4


def packed(files: DataFrame) -> DataFrame:
    """Read by no more than ``READERS`` tasks a core, each its files in order; where files are large, by as many as there are splits of 128 MB."""
    most = READERS * files.sparkSession.sparkContext.defaultParallelism
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files.coalesce(max(most, size >> 27))


def read_book_files(spark: SparkSession, root: str) -> DataFrame:
    """(book_id, file_name, content) of the text files in the folders right below ``root`` that hold ``index.txt``.

    Bytes that are not UTF-8 are replaced.
    """
    raw = packed(spark.read.format("binaryFile").load(**folders(root)))
    parts = F.split("path", "/")
    files = raw.select(
        F.element_at(parts, -2).alias("book_id"),
        F.element_at(parts, -1).alias("file_name"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("content"),
    )
    return files.join(files.where("file_name = 'index.txt'").select("book_id"), "book_id", "left_semi")


def write_book_files(files: DataFrame, root: str) -> DataFrame:
    """Write (book_id, file_name, content) as folders of text files below ``root``, a URI that ``pyarrow.fs`` opens; returns what was written.

    Names are fixed by the rows, so a repeated task writes the same bytes again. Nothing is
    written until the result is used.
    """

    def run(batches):
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        made = set()
        for pdf in batches:
            for book, name, content in zip(pdf["book_id"], pdf["file_name"], pdf["content"], strict=True):
                if book not in made:
                    fs.create_dir(f"{base}/{book}", recursive=True)
                    made.add(book)
                with fs.open_output_stream(f"{base}/{book}/{name}") as out:
                    out.write((content or "").encode())
            yield pdf[["book_id", "file_name"]]

    return files.select("book_id", "file_name", "content").mapInPandas(run, "book_id string, file_name string")


def split_lines(text: Column) -> Column:
    """Lines at any Unicode line end; a final line end adds no empty line."""
    return let(F.split(text, LINE_END, -1), lambda a: F.when(F.element_at(a, -1) == "", F.slice(a, 1, F.size(a) - 1)).otherwise(a))


def file_order(files: DataFrame) -> DataFrame:
    """(book_id, file_name, file_ord): files named by the menu, in its order and with repeats, if any of them exists;
    else all-digit names by number; else ``index.txt``."""
    names = files.select("book_id", "file_name")
    block = F.regexp_extract("content", r"(?s)<menu>(.*?)</menu>", 1)
    menu = files.where("file_name = 'menu.txt'").select("book_id", F.posexplode(split_lines(block)).alias("pos", "line"))
    menu = menu.select("book_id", "pos", F.concat(strip(F.element_at(F.split("line", r"\|", 2), 1)), F.lit(".txt")).alias("file_name"))
    number = F.regexp_extract("file_name", r"^([0-9]+)[.]txt$", 1).try_cast("decimal(38,0)")
    key = lambda c: c.cast("decimal(38,0)").alias("key")
    listed = menu.join(names, ["book_id", "file_name"]).select("book_id", "file_name", F.lit(0).alias("kind"), key(F.col("pos")))
    others = names.select("book_id", "file_name", F.when(number.isNotNull(), 1).when(F.col("file_name") == "index.txt", 2).alias("kind"), key(F.coalesce(number, F.lit(0)))).where("kind is not null")
    # A book keeps the first kind that it has: one window instead of anti-joins.
    best = F.min("kind").over(Window.partitionBy("book_id"))
    kept = listed.union(others).withColumn("best", best).where("kind = best")
    order = Window.partitionBy("book_id").orderBy("key", "file_name")
    return kept.select("book_id", "file_name", F.row_number().over(order).alias("file_ord"))


def _body() -> Column:
    return F.when(F.col("file_name") == "index.txt", F.regexp_replace("content", r"(?s)<book>(.*?)</book>", "")).otherwise(F.col("content"))


def book_lines(files: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """(book_id, line_no, line): the files' lines one after another; the metadata block of ``index.txt`` is left out.

    Only the files' line counts meet in a window of a book; lines are numbered inside their file.
    """
    order = order if order is not None else file_order(files)
    dealt = files.join(order, ["book_id", "file_name"]).repartition("book_id", "file_ord")  # files of one book go to all tasks
    cut = dealt.select("book_id", "file_ord", split_lines(_body()).alias("lines"))
    before = Window.partitionBy("book_id").orderBy("file_ord").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.select("book_id", "file_ord", F.size("lines").cast("long").alias("n"))
    offsets = counts.select("book_id", "file_ord", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = cut.join(offsets, ["book_id", "file_ord"]).select("book_id", "offset", F.posexplode("lines").alias("pos", "line"))
    return numbered.select("book_id", (F.col("offset") + F.col("pos") + 1).alias("line_no"), "line")


def book_pieces(files: DataFrame) -> DataFrame:
    """(book_id, piece, body): the files in their order, without the metadata block of ``index.txt``; lines as in ``book_lines``."""
    order = stored(file_order(files), "order")
    return files.join(sent_if_small(order, 250), ["book_id", "file_name"]).select("book_id", F.col("file_ord").alias("piece"), _body().alias("body"))


def metadata_map(index_text: Column) -> Column:
    """key -> value of the first ``<book>`` block; lines split at their first ``=``; of a repeated key the last counts."""
    lines = split_lines(F.regexp_extract(index_text, r"(?s)<book>(.*?)</book>", 1))
    pairs = F.transform(
        F.filter(F.transform(lines, strip), lambda line: F.contains(line, F.lit("="))),
        lambda line: F.struct(strip(F.substring_index(line, "=", 1)).alias("key"), strip(line.substr(F.instr(line, "=") + 1, F.length(line))).alias("value")),
    )
    last = let(pairs, lambda ps: F.filter(ps, lambda p, i: ~F.exists(F.slice(ps, i + 2, F.size(ps)), lambda q: q["key"] == p["key"])))
    return F.map_from_entries(last)


def catalog(files: DataFrame, homepage: str = SOURCE_HOMEPAGE, simplified: dict[str, str] | None = None) -> DataFrame:
    """One row of metadata for each book."""
    index = files.where("file_name = 'index.txt'").select("book_id", metadata_map(F.col("content")).alias("m"))
    at = lambda k: F.try_element_at("m", F.lit(k))
    full = lambda k: F.nullif(at(k), F.lit(""))
    # Of the two keys that name a base text, the first that is not empty; else the edition, even if empty.
    base_text = F.coalesce(full("參本"), full("底本"), at("版本"))
    title = F.coalesce(at("書名"), F.col("book_id"))
    return index.select(
        "book_id",
        title.alias("book_title_trad"),
        to_simplified(title, simplified).alias("book_title_simp"),
        at("作者").alias("author"),
        at("作者描述").alias("author_note"),
        at("朝代").alias("dynasty"),
        at("年份").alias("year"),
        classify.category_level_1(at("分類")).alias("category_level_1"),
        classify.category_level_2(at("分類")).alias("category_level_2"),
        F.coalesce(at("分類"), F.lit("")).alias("category_raw"),
        base_text.alias("base_text"),
        at("品質").alias("quality_score_source"),
        classify.quality_tier(at("品質")).alias("quality_tier"),
        book_url(F.col("book_id"), homepage).alias("source_url"),
        F.map_filter("m", lambda k, _: ~k.isin(*META_KEYS)).alias("extra"),
    )
