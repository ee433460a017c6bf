"""WARC archives written and read as chunked record tables.

A payload travels as a run of rows ``(record, chunk_no, chunk, bytes_so_far, sha1_so_far,
last)`` with the digest and length of everything up to it, so any prefix can be verified
and the last row carries the record's digest. Only responses have payload rows: which
records are revisits is known from digests before a payload moves. The rows of a record
are shuffled to one place and sorted; a writer streams them into a gzip member, a reader
inflates and cuts archives into the same rows, and results are summed over all of these.

Archives go to a shared folder (any store that ``pyarrow.fs`` opens by URI). A task
writes a file of its own name and reports it in a manifest that Spark commits as a
table: what a lost or repeated task left behind is in no manifest and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch_path

CHUNK = 1 << 20
#: Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

CHUNK_SCHEMA = "page_id long, chunk_no long, chunk binary, bytes_so_far long, sha1_so_far string, last boolean"


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode().rstrip("=")


def chunks(payload: Iterable[bytes], size: int = CHUNK) -> Iterator[tuple[int, bytes, int, str, bool]]:
    """(chunk_no, chunk, bytes_so_far, sha1_so_far, last) for a stream of pieces; an empty payload is one empty chunk."""
    sha, total, no, held = hashlib.sha1(), 0, 0, bytearray()

    def row(piece: bytes, last: bool):
        nonlocal total, no
        sha.update(piece)
        total, no = total + len(piece), no + 1
        return no - 1, piece, total, base32_sha1(sha.copy()), last

    for piece in payload:
        view = memoryview(piece)
        for at in range(0, len(view), size):
            held += view[at : at + size]
            while len(held) > size:
                yield row(bytes(held[:size]), False)
                del held[:size]
    yield row(bytes(held), True)


_ARROW = pa.schema([("page_id", pa.int64()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("sha1_so_far", pa.string()), ("last", pa.bool_())])


_RECORDS = pa.schema(
    [("place", pa.int64()), ("kind", pa.int32()), ("record", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("sha", pa.string()), ("payload_bytes", pa.int64()), ("first_page", pa.int64()), *list(_ARROW)[1:]]
)


def _batch(rows: list[tuple], schema: pa.Schema = _ARROW) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def payload_keys(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, sha, payload_bytes) with the hex SHA-1 and length of the UTF-8 payload; null html is empty."""
    html = F.coalesce("html", F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html).alias("sha"), F.octet_length(html).cast("long").alias("payload_bytes"))


def shared_payloads(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(sha, payload_bytes, first_page, rows_of_first) of payloads that are long enough and that several rows of ``digests`` hold.

    Counts are combined before the shuffle, so a payload that a third of all rows share is
    one row per task; no payload moves here.
    """
    by_page = digests.where(F.col("payload_bytes") >= min_bytes).groupBy("sha", "payload_bytes", "page_id").agg(F.count(F.lit(1)).alias("n"))
    shared = by_page.groupBy("sha", "payload_bytes").agg(F.min("page_id").alias("first_page"), F.min_by("n", "page_id").alias("rows_of_first"), F.sum("n").alias("rows"))
    return shared.where("rows > 1 and first_page is not null").drop("rows")


def record_id(page_id, sha: str, row: int | None = None) -> str:
    """The id of a payload's response; with ``row``, of any other record."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page/{page_id}/{sha}' + ('' if row is None else f'/{row}'))}>"


#: Kinds of records: a response that none refers to, one that revisits refer to, a candidate for such a response, a revisit.
PLAIN, REFERRED, CANDIDATE, REVISIT = range(4)
RECORD_SCHEMA = "place long, kind int, record long, page_id long, url string, sha string, payload_bytes long, first_page long, " + CHUNK_SCHEMA.removeprefix("page_id long, ")


def record_chunks(pages: DataFrame, min_bytes: int = 0, size: int = CHUNK, limit: int = 64 << 20) -> DataFrame:
    """The chunked record table to be written: rows of ``RECORD_SCHEMA``, none of them larger than ``size``.

    A record that is surely a revisit is one row without payload. If several rows repeat
    the first page of a payload, one of them in each task keeps its payload and these
    candidates meet for the writer to choose; the others are revisits. The table of shared
    payloads is broadcast while proven to stay under ``limit`` bytes, and shuffled beyond.
    """
    keyed = payload_keys(pages)
    digests = materialize(keyed.select("page_id", "sha", "payload_bytes"), "warc-digests")
    shared = materialize(shared_payloads(digests, min_bytes), "warc-shared")
    shared = F.broadcast(shared) if shared.count() * 150 <= limit else shared
    marked = keyed.withColumn("record", F.monotonically_increasing_id()).join(shared, ["sha", "payload_bytes"], "left")
    first = F.coalesce(F.col("page_id") == F.col("first_page"), F.lit(False))
    kind = F.when(F.col("first_page").isNull(), PLAIN).when(~first, REVISIT).when(F.col("rows_of_first") == 1, REFERRED).otherwise(CANDIDATE)
    marked = marked.select("record", "page_id", "url", "sha", "payload_bytes", "first_page", kind.alias("kind"), F.when(kind != REVISIT, F.col("html")).alias("html"))

    def run(batches):
        met: set[tuple[int, str]] = set()  # repeated first pages of this task
        for batch in batches:
            rows, held = [], 0
            texts = batch.column("html").cast(pa.large_binary())
            meta = zip(*(batch.column(c).to_pylist() for c in ("record", "page_id", "url", "sha", "payload_bytes", "first_page", "kind")), texts, strict=True)
            for record, page_id, url, sha, total, first, kind, text in meta:
                if kind == CANDIDATE:
                    kind = REVISIT if (page_id, sha) in met else CANDIDATE
                    met.add((page_id, sha))
                about = (int(sha[:15], 16) if kind == CANDIDATE else record, kind, record, page_id, url, sha, total, first)
                buffer = memoryview(text.as_buffer()) if kind != REVISIT and text.is_valid else memoryview(b"")
                for x in chunks((buffer[at : at + size] for at in range(0, len(buffer), size)), size):
                    rows.append((*about, *x))
                    held += len(x[1]) + 200
                    if held > 4 * size:
                        yield _batch(rows, _RECORDS)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, _RECORDS)

    return marked.mapInArrow(run, RECORD_SCHEMA)


def _head(kind: str, page_id, row: int | None, uri: str, date: str, sha: str, total: int, refers_to) -> bytes:
    """Record head and HTTP head. Header values hold no line breaks."""
    digest = base64.b32encode(bytes.fromhex(sha)).decode()
    one_line = lambda s: " ".join(str(s).split())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {total}\r\n\r\n".encode()
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id, sha, row)),
        ("WARC-Date", date),
        ("WARC-Target-URI", one_line(uri or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Page-ID", "" if page_id is None else page_id),
    ]
    if kind == "revisit":
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha)), ("WARC-Refers-To-Page-ID", refers_to)]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(http) + (total if kind == "response" else 0))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + http


class _Member:
    """One gzip member, compressed while it is written."""

    def __init__(self, out, level: int):
        self.out, self.z = out, zlib.compressobj(level, zlib.DEFLATED, 31)

    def write(self, data) -> None:
        if packed := self.z.compress(data):
            self.out.write(packed)

    def close(self) -> None:
        self.out.write(self.z.flush())


class _Archive:
    """The files that one task writes; a new one starts beyond ``roll`` bytes."""

    def __init__(self, folder: str, level: int, roll: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.level, self.roll, self.n, self.out, self.done = level, roll, 0, None, []
        context = TaskContext.get()
        self.name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}" if context else f"part-{os.getpid()}"

    def begin(self, head: bytes) -> None:
        if self.out is None:
            self.path = f"{self.folder}/{self.name}-{self.n:03d}.warc.gz"
            self.out, self.records = self.fs.open_output_stream(self.path), 0
        self.member = _Member(self.out, self.level)
        self.member.write(head)

    def end(self) -> None:
        self.member.write(b"\r\n\r\n")
        self.member.close()
        self.records += 1
        if self.out.tell() >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.done.append((f"{self.name}-{self.n:03d}.warc.gz", self.records, self.out.tell()))
            self.out.close()
            self.out, self.n = None, self.n + 1


_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 1, roll: int = 1 << 30, size: int = CHUNK) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``; returns the manifest (file, records, bytes).

    Of rows with equal payloads of at least ``min_bytes`` bytes, that with the smallest
    page_id is a response and the others are revisits of it; shorter ones are responses.
    Of rows that repeat page_id and payload one is the response. A null page_id is
    never referred to while its payload has another; if it has none all are responses.
    Null html is an empty payload, null url an empty URI. No rows: no files. Columns
    besides these three are not read.

    Records are dealt by a row number, so neither one page, nor null ids, nor one payload
    burden a task.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = record_chunks(pages, min_bytes, size).repartition(parts, "place").sortWithinPartitions("place", "page_id", "sha", "record", "chunk_no")

    def run(batches):
        archive = _Archive(folder, level, roll)
        chosen = now = running = None
        for batch in batches:
            meta = zip(*(batch.column(c).to_pylist() for c in ("kind", "record", "page_id", "url", "sha", "payload_bytes", "first_page", "chunk_no", "bytes_so_far", "sha1_so_far", "last")), batch.column("chunk"), strict=True)
            for kind, record, page_id, url, sha, total, first, no, upto, digest, last, chunk in meta:
                if no == 0:
                    now, running = record, hashlib.sha1()
                    revisit = kind == REVISIT or (kind == CANDIDATE and chosen == (page_id, sha))
                    if kind == CANDIDATE:
                        chosen = (page_id, sha)
                    named = record if revisit or kind == PLAIN else None
                    archive.begin(_head("revisit" if revisit else "response", page_id, named, url, date, sha, total, first))
                elif record != now:
                    raise ValueError("chunks of two records are mixed")
                if not revisit:
                    piece = memoryview(chunk.as_buffer())
                    running.update(piece)
                    archive.member.write(piece)
                    if last and (upto != total or running.hexdigest() != sha or base32_sha1(running) != digest):
                        raise ValueError("a payload changed while it was written")
                if last:
                    archive.end()
        archive.close()
        if archive.done:
            yield _batch(archive.done, _MANIFEST)

    return materialize(rows.mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


class _Source:
    """Lines and runs of bytes from a stream of gzip members, inflated a chunk at a time."""

    def __init__(self, raw, size: int = CHUNK):
        self.raw, self.size, self.held, self.z, self.left = raw, size, bytearray(), zlib.decompressobj(31), b""

    def _more(self) -> bool:
        while True:
            if self.z.eof:
                self.left, self.z = self.z.unused_data or self.left, zlib.decompressobj(31)
            data = self.left or self.raw.read(self.size)
            self.left = b""
            if not data:
                return False
            out = self.z.decompress(data, self.size)
            self.left = self.z.unconsumed_tail
            if self.z.eof:
                self.left = self.z.unused_data
                self.z = zlib.decompressobj(31)
            if out:
                self.held += out
                return True

    def line(self) -> bytes | None:
        start = 0
        while (at := self.held.find(b"\r\n", start)) < 0:
            start = max(0, len(self.held) - 1)
            if not self._more():
                if self.held:
                    raise EOFError("an archive ends inside a line")
                return None
        line = bytes(self.held[:at])
        del self.held[: at + 2]
        return line

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise EOFError("an archive ends inside a record")
            piece = bytes(self.held[: min(n, self.size)])
            del self.held[: len(piece)]
            n -= len(piece)
            yield piece


def _fields(source: _Source) -> dict[bytes, bytes]:
    found = {}
    while line := source.line():
        key, _, value = line.partition(b":")
        found[key.strip().lower()] = value.strip()
    return found


def read_records(stream) -> Iterator[tuple[dict, dict, Iterator[bytes]]]:
    """(WARC fields, HTTP fields, payload pieces) of each record; the pieces must be used up before the next record."""
    source = _Source(stream)
    while (version := source.line()) is not None:
        if version != VERSION:
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        warc = _fields(source)
        status = source.line()
        http = _fields(source)
        payload = int(http[b"content-length"]) if warc[b"warc-type"] == b"response" else 0
        if not (status or b"").startswith(b"HTTP/"):
            raise ValueError("a record without an HTTP head")
        yield warc, http, source.take(payload)
        if source.line() != b"" or source.line() != b"":
            raise ValueError("a record does not end where its length says")


_READ = pa.schema([*_ARROW, ("record", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, size: int = CHUNK) -> DataFrame:
    """The chunked record table of the archives in ``manifest``, with each record's id, type, referred page, length and digest.

    Revisits hold no payload: they are one empty chunk, with the length and digest of the
    payload they refer to. Digests are verified while reading.
    """
    parts = max(1, min(manifest.count(), 10 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, root = pafs.FileSystem.from_uri(folder)
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}") as stream:
                    for warc, http, pieces in read_records(stream):
                        page = int(warc[b"warc-page-id"]) if warc[b"warc-page-id"] else None
                        kind = warc[b"warc-type"].decode()
                        refers_to = int(warc[b"warc-refers-to-page-id"]) if kind == "revisit" else None
                        digest = warc[b"warc-payload-digest"].decode().removeprefix("sha1:")
                        rest = (warc[b"warc-record-id"].decode(), kind, refers_to, int(http[b"content-length"]), digest)
                        for no, piece, total, running, last in chunks(pieces, size):
                            if last and kind == "response" and running != digest:
                                raise ValueError(f"page {page}: the payload does not have its digest")
                            rows.append((page, no, piece, total, running, last, *rest))
                            held += len(piece) + 200
                            if held > 4 * size:
                                yield _batch(rows, _READ)
                                rows, held = [], 0
                if rows:
                    yield _batch(rows, _READ)

    schema = f"{CHUNK_SCHEMA}, record string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return manifest.select("file").repartition(parts).mapInArrow(run, schema)


def records(table: DataFrame) -> DataFrame:
    """A row per record of a chunked record table, from all its chunk rows: page_id, payload_bytes, payload_digest, record_type, refers_to, chunks.

    A response has the summed length of its chunks and the digest that its last chunk
    carries, a revisit those of the payload it refers to. A record that lacks a chunk fails.
    """
    whole = table.groupBy("record").agg(
        *[F.first(c).alias(c) for c in ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")],
        F.sum(F.octet_length("chunk")).alias("held"), F.count(F.lit(1)).alias("chunks"), F.max("chunk_no").alias("last_no"), F.max_by("sha1_so_far", "chunk_no").alias("running"),
    )
    response = F.col("record_type") == "response"
    fits = (F.col("chunks") == F.col("last_no") + 1) & (~response | (F.col("held") == F.col("payload_bytes")))
    size = F.when(fits, F.when(response, F.col("held")).otherwise(F.col("payload_bytes"))).otherwise(F.raise_error(F.concat(F.lit("chunks are missing: "), "record")).cast("long"))
    return whole.select("page_id", size.alias("payload_bytes"), F.when(response, F.col("running")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to", "chunks")


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, and return a row per record."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    return records(read_archives(pages.sparkSession, manifest, folder))
