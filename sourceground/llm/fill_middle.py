"""Fill-in-middle rearrangement with piece tables.

A document is a list of descriptors (buffer, start, length) over two buffers that never
change: its own UTF-8 bytes and the sentinels. Cutting splits a descriptor, an arrangement
permutes descriptors and puts sentinels between them, and hashing streams the descriptors
one after the other; no text is copied until ``rendered`` writes it out. ``restored``
cuts an arranged text at its sentinels and undoes the permutation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buffers of a descriptor.
TEXT, SENTINELS = 0, 1
MARKS = ("<P>", "<S>", "<M>")
#: For each form the order of (prefix, suffix, middle), each behind its own sentinel but the
#: last two of ``spm``, whose sentinels follow the contract: suffix first, then prefix.
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
MARK_OF = {"prefix": 0, "suffix": 1, "middle": 2}
BLOCK = 1 << 20

PIECES = "array<struct<buffer:int,start:long,length:long>>"


def cut(pieces: list[tuple[int, int, int]], at: list[int]) -> list[list[tuple[int, int, int]]]:
    """Split a piece table at ascending offsets into the tables of the ranges between them."""
    out, own, seen, ends = [], [], 0, iter([*at, None])
    end = next(ends)
    for buffer, start, length in pieces:
        while end is not None and end <= seen + length:
            if end > seen:
                own.append((buffer, start, end - seen))
            out.append(own)
            start, length, seen, own = start + end - seen, length - (end - seen), end, []
            end = next(ends)
        if length:
            own.append((buffer, start, length))
            seen += length
    while end is not None:  # offsets at or beyond the end
        out.append(own)
        own, end = [], next(ends)
    return [*out, own]


def arranged(parts: dict[str, list], form: str) -> list[tuple[int, int, int]]:
    """The parts in the order of ``form``, each behind its sentinel."""
    width = len(MARKS[0])
    return [piece for name in ORDERS[form] for piece in ((SENTINELS, MARK_OF[name] * width, width), *parts[name])]


def streamed(pieces: list[tuple[int, int, int]], buffers: tuple) -> str:
    """SHA-256 of the bytes that the descriptors name, block by block."""
    seen = hashlib.sha256()
    for buffer, start, length in pieces:
        for at in range(start, start + length, BLOCK):
            seen.update(buffers[buffer][at : min(at + BLOCK, start + length)])
    return seen.hexdigest()


def read_back(output, form: str) -> list[tuple[int, int, int]]:
    """The original text as descriptors over an arranged ``output`` (bytes): cut at the sentinels, inverse permutation."""
    whole = [(TEXT, 0, len(output))]
    if form not in ORDERS:
        return whole
    width, ends, at = len(MARKS[0]), [], 0
    for name in ORDERS[form]:
        at = output.find(MARKS[MARK_OF[name]].encode(), at)
        ends += [at, at + width]
        at += width
    ranges = cut(whole, ends)[2::2]
    held = dict(zip(ORDERS[form], ranges, strict=True))
    return held["prefix"] + held["middle"] + held["suffix"]


def line_ends(text) -> np.ndarray:
    """Byte offsets behind each line; the last line may lack its line feed."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if len(text) == 0 or (len(ends) and ends[-1] == len(text)) else np.append(ends, len(text))


def code_points(text) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)) if len(text) else 0


def _buffer(value) -> memoryview:
    return memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")


def _draw(doc_id: Column, seed: int, group: int) -> Column:
    """Group ``group`` of eight hex digits of sha256(seed:doc_id), as an unsigned number; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def arrange(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, pieces) for every row of ``docs``.

    The text is cut into ``n`` lines; two draws from the id choose where the prefix and the
    middle end, a third whether the text is rearranged (``rate`` in 100) and a fourth which
    form it takes (``spm`` in 100). Texts that are empty, null (as empty) or hold a sentinel
    stay plain: then ``prefix_chars`` and ``middle_chars`` are null and ``pieces`` is the
    text itself. Other columns are not read; rows that repeat are rows like others; an
    empty table gives an empty result.
    """

    def run(batches):
        for batch in batches:
            n, forms, before, between, tables = [], [], [], [], []
            draws = [batch.column(f"__h{k}").to_pylist() for k in range(1, 5)]
            for value, h1, h2, h3, h4 in zip(batch.column("text"), *draws, strict=True):
                text = _buffer(value)
                ends = line_ends(text)
                whole = [(TEXT, 0, len(text))] if len(text) else []
                held = bytes(text)
                plain = not whole or h3 % 100 >= rate or any(m.encode() in held for m in MARKS)
                form = "plain" if plain else ("spm" if h4 % 100 < spm else "psm")
                n.append(len(ends))
                forms.append(form)
                if plain:
                    before.append(None)
                    between.append(None)
                    tables.append(whole)
                    continue
                units = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
                a, b = (int(ends[u - 1]) if u else 0 for u in units)
                parts = dict(zip(("prefix", "middle", "suffix"), cut(whole, [a, b]), strict=True))
                before.append(code_points(text[:a]))
                between.append(code_points(text[a:b]))
                tables.append(arranged(parts, form))
            flat = [p for table in tables for p in table]
            starts = np.cumsum([0, *map(len, tables)]).astype(np.int32)
            fields = [pa.array([p[k] for p in flat], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            pieces = pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays(fields, ["buffer", "start", "length"]))
            columns = [batch.column("doc_id"), batch.column("text"), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64()), pa.array(between, pa.int64()), pieces]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "pieces"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    drawn = docs.select("doc_id", "text", *(_draw(F.col("doc_id"), seed, k - 1).alias(f"__h{k}") for k in range(1, 5)))
    return drawn.mapInArrow(run, f"doc_id {doc_type}, text string, n long, form string, prefix_chars long, middle_chars long, pieces {PIECES}")


def _buffers(text) -> tuple:
    return text, memoryview("".join(MARKS).encode())


def _tables(batch):
    """(text bytes, descriptors) of each row."""
    for value, pieces in zip(batch.column("text"), batch.column("pieces").to_pylist(), strict=True):
        yield _buffer(value), [(p["buffer"], p["start"], p["length"]) for p in pieces]


def _mapped(pieced: DataFrame, added: str, build) -> DataFrame:
    """``pieced`` without text and pieces, with the columns that ``build`` makes from each row's form, text and descriptors."""
    kept = [c for c in pieced.columns if c not in ("text", "pieces")]

    def run(batches):
        for batch in batches:
            forms = batch.column("form").to_pylist()
            got = [build(form, *row) for form, row in zip(forms, _tables(batch), strict=True)]
            columns = [pa.array([g[k] for g in got], pa.string()) for k in range(len(added.split(",")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, *(a.split()[0] for a in added.split(","))])

    schema = ", ".join(f"{c} {pieced.schema[c].dataType.simpleString()}" for c in kept)
    return pieced.mapInArrow(run, f"{schema}, {added}")


def _written(text, pieces) -> bytes:
    buffers = _buffers(text)
    return b"".join(buffers[b][s : s + n] for b, s, n in pieces)


def rendered(pieced: DataFrame) -> DataFrame:
    """The arranged texts themselves: ``output`` instead of ``text`` and ``pieces``."""
    return _mapped(pieced, "output string", lambda form, text, pieces: (_written(text, pieces).decode(),))


def restored(outputs: DataFrame) -> DataFrame:
    """``text`` rebuilt from ``output`` and ``form`` alone."""
    kept = [c for c in outputs.columns if c != "output"]

    def run(batches):
        for batch in batches:
            texts = []
            for form, value in zip(batch.column("form").to_pylist(), batch.column("output"), strict=True):
                own = bytes(_buffer(value))
                texts.append(b"".join(own[s : s + n] for _, s, n in read_back(own, form)).decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = ", ".join(f"{c} {outputs.schema[c].dataType.simpleString()}" for c in kept)
    return outputs.mapInArrow(run, f"{schema}, text string")


def digests(pieced: DataFrame) -> DataFrame:
    """``output_sha256`` from the streamed descriptors, ``restored_sha256`` from the output read back."""

    def build(form, text, pieces):
        output = _written(text, pieces)
        return streamed(pieces, _buffers(text)), streamed(read_back(output, form), (memoryview(output),))

    return _mapped(pieced, "output_sha256 string, restored_sha256 string", build)
