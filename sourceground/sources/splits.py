"""Lines of book files of any size, read in splits: no file is ever one cell.

Folders are listed and files are read in byte ranges by tasks, so the driver holds nothing for
each file. A line's place in its file is its place in the chunk that was read plus the lines of the
chunks before it; only one row for each chunk meets in a window of its file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import LINE_END
from .books import READERS, file_order
from .scratch import sent_if_small, stored

FILE = ["book_id", "file_name"]
BOOK_BLOCK = r"(?s)<book>(.*?)</book>"


#: Bytes of a range of a file, which one task reads, and of what is read and handed on together.
RANGE, READ = 128 << 20, 8 << 20
CHUNK = pa.schema([("book_id", pa.string()), ("file_name", pa.string()), ("block", pa.int64()), ("c", pa.int32()), ("alone", pa.bool_()), ("ended", pa.bool_()), ("data", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(book_id, file_name, size) of the text files in the folders right below ``root``, a URI that ``pyarrow.fs`` opens.

    A task lists a folder; the driver knows the folders, but no file. Empty files are left out, as Spark's readers leave them.
    """

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        schema = pa.schema([("book_id", pa.string()), ("file_name", pa.string()), ("size", pa.int64())])
        for batch in batches:
            for book in batch.column("book_id").to_pylist():
                files = fs.get_file_info(pafs.FileSelector(f"{base}/{book}"))
                for at in range(0, len(files), 10_000):
                    if rows := [(book, f.base_name, f.size) for f in files[at : at + 10_000] if f.is_file and f.size and f.base_name.endswith(".txt") and f.base_name[0] not in "._"]:
                        yield _batch(rows, schema)

    fs, base = pafs.FileSystem.from_uri(root)
    books = [(f.base_name,) for f in fs.get_file_info(pafs.FileSelector(base)) if f.type == pafs.FileType.Directory]
    return spark.createDataFrame(books, "book_id string").repartition(max(1, len(books))).mapInArrow(run, "book_id string, file_name string, size long")


def _chunks(file, block: int, size: int, length: int, most: int) -> Iterator[tuple[bytes, bool]]:
    """Bytes of the lines that begin in the ``length`` bytes at ``block``, read ``most`` bytes at a time, cut behind line feeds; with each, does the file end there?"""
    at, end, held = block, min(block + length, size), b""
    if block:  # the line that goes on from the range before is read there
        at -= 1
        file.seek(at)
        while (skipped := (data := file.read(1 << 16)).find(b"\n")) < 0:
            if not data:
                return
            at += len(data)
        at += skipped + 1
        file.seek(at)
    while at < end:
        data = file.read(most)
        held += data
        if not data:
            yield held, True
            return
        last = held.find(b"\n", max(0, end - at - 1))  # ends the last line that begins before ``end``
        cut = (last if last >= 0 else held.rfind(b"\n")) + 1
        if cut:
            yield held[:cut], at + cut == size
        if last >= 0:
            return
        at, held = at + cut, held[cut:]


def read_lines(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """(book_id, file_name, pos, line, open_end) of all text files in the folders below ``root`` (or those of ``files``, as listed); ``pos`` counts from 0 in a file.

    Lines end at any Unicode line end and a final line end adds no empty line; ``open_end`` tells a last line without
    one. Bytes that are not UTF-8 are replaced. Empty files have no rows.
    """
    files = files if files is not None else stored(list_files(spark, root), "split-names")
    total = files.agg(F.sum("size")).first()[0] or 0
    ranges = files.select(*FILE, "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(RANGE).cast("long"))).alias("block"))
    tasks = max(READERS * spark.sparkContext.defaultParallelism, total // RANGE)

    length, most = RANGE, READ

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            held, size = [], 0
            for book, name, whole, block in zip(*(batch.column(c).to_pylist() for c in (*FILE, "size", "block")), strict=True):
                with fs.open_input_file(f"{base}/{book}/{name}") as file:
                    for c, (data, ended) in enumerate(_chunks(file, block, whole, length, most)):
                        held.append((book, name, block, c, not block and not c and ended, ended, data))
                        size += len(data)
                        if size >= most:
                            yield _batch(held, CHUNK)
                            held, size = [], 0
            if held:
                yield _batch(held, CHUNK)

    read = ranges.repartition(tasks, *FILE, "block").mapInArrow(run, "book_id string, file_name string, block long, c int, alone boolean, ended boolean, data binary")
    pieces = read.withColumn("a", F.split(F.make_valid_utf8(F.col("data").cast("string")), LINE_END, -1))
    full_end = F.element_at("a", -1) == ""
    chunks = stored(pieces.select(*FILE, "block", "c", "alone", (F.col("ended") & ~full_end).alias("open"), F.when(full_end, F.slice("a", 1, F.size("a") - 1)).otherwise(F.col("a")).alias("lines")), "split-lines")
    # Only files of several chunks need to be told where a chunk begins.
    before = Window.partitionBy(*FILE).orderBy("block", "c").rowsBetween(Window.unboundedPreceding, -1)
    some = chunks.where("not alone")
    places = stored(some.select(*FILE, "block", "c", F.coalesce(F.sum(F.size("lines").cast("long")).over(before), F.lit(0)).alias("shift")), "split-ranges")
    columns = [*FILE, "shift", "open", "lines"]
    found = chunks.where("alone").withColumn("shift", F.lit(0).cast("long")).select(*columns).unionByName(some.join(sent_if_small(places, 250), [*FILE, "block", "c"]).select(*columns))
    rows = found.select(*FILE, "shift", F.when(F.col("open"), F.size("lines") - 1).alias("last"), F.posexplode("lines").alias("k", "line"))
    return rows.select(*FILE, (F.col("shift") + F.col("k")).alias("pos"), "line", F.coalesce(F.col("k") == F.col("last"), F.lit(False)).alias("open_end"))


def _joined(rows: DataFrame, by: list[str]) -> DataFrame:
    lines = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return rows.groupBy(*by).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("content"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("open_end").alias("open_end"))


def heads(lines: DataFrame, names: DataFrame) -> DataFrame:
    """(book_id, file_name, content, first, last, open_end) of every file: the metadata region of ``index.txt``, the whole menu, null for others.

    The region runs from the first line with ``<book>`` to the last with ``</book>``, so it
    holds every metadata block, and only it is one cell.
    """
    index = lines.where("file_name = 'index.txt'")
    opened = index.where(F.contains("line", F.lit("<book>"))).groupBy("book_id").agg(F.min("pos").alias("__from"))
    closed = index.where(F.contains("line", F.lit("</book>"))).groupBy("book_id").agg(F.max("pos").alias("__to"))
    region = _joined(index.join(opened, "book_id").join(closed, "book_id").where("pos between __from and __to"), FILE)
    menu = _joined(lines.where("file_name = 'menu.txt'"), FILE)
    return names.select(*FILE).join(region.unionByName(menu), FILE, "left")


def read_books(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(files, lines) of the folders right below ``root`` that hold ``index.txt``.

    ``files`` serves ``catalog`` and ``file_order``: contents are the metadata of ``index.txt`` and
    menus only. ``lines`` is (book_id, line_no, line) as ``book_lines`` gives it.
    """
    names = stored(list_files(spark, root), "split-listed")
    names = stored(names.join(names.where("file_name = 'index.txt'").select("book_id"), "book_id", "left_semi"), "split-names")
    lines = read_lines(spark, root, names)
    files = stored(heads(lines, names), "split-heads")
    return files.select(*FILE, F.coalesce("content", F.lit("")).alias("content")), numbered_lines(lines, files)


def numbered_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """(book_id, line_no, line): the files' lines one after another, without the metadata blocks."""
    region = files.where("file_name = 'index.txt' and first is not null")
    left = F.split(F.regexp_replace("content", BOOK_BLOCK, ""), LINE_END, -1)
    left = F.when(F.col("open_end") & (F.element_at(left, -1) == ""), F.slice(left, 1, F.size(left) - 1)).otherwise(left)
    region = stored(region.select(*FILE, "first", "last", left.alias("left")), "split-regions")
    inserted = region.select(*FILE, "first", F.posexplode("left").alias("k", "line")).select(*FILE, (F.col("first") + F.col("k")).alias("pos"), "line")
    moved = lines.join(sent_if_small(region.select(*FILE, "first", "last", F.size("left").alias("size")), 250), FILE, "left").where("first is null or pos < first or pos > last")
    pos = F.when(F.col("pos") > F.col("last"), F.col("pos") - (F.col("last") - F.col("first") + 1) + F.col("size")).otherwise(F.col("pos"))
    body = stored(moved.select(*FILE, pos.alias("pos"), "line").unionByName(inserted), "split-body")
    order = file_order(files.select(*FILE, F.coalesce("content", F.lit("")).alias("content")))
    counts = order.join(body.groupBy(*FILE).agg(F.count(F.lit(1)).alias("n")), FILE, "left")
    before = Window.partitionBy("book_id").orderBy("file_ord").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select(*FILE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "split-offsets")
    return body.join(sent_if_small(offsets, 250), FILE).select("book_id", (F.col("offset") + F.col("pos") + 1).alias("line_no"), "line")
