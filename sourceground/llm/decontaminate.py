"""Benchmark decontamination: a BM25 index of test items, queried by every training passage.

The index is over items; a passage is a query. A posting's impact is its BM25 weight
divided by the item's own threshold (``share`` of the score that the item gives itself),
so an item is retrieved where impacts reach 1. Items are grouped in blocks; each term has
its largest impact in each block. The block maxima are first added up for many passages at
once (frequent terms, whose impacts together lift no item far, enter as one bound), which
leaves the few passages that can reach 1 in any block. On these, block-max WAND runs item
by item: term cursors are kept in item order, the pivot is the first item that maxima can
lift to 1, whole blocks are skipped where block maxima cannot, and only pivots that all
cursors have reached are scored. Retrieval is exact: all above the threshold are scored.

What is retrieved is verified on word shingles: of the item's question and of its answer
(its last sentence), at least 0.8 of the five-word shingles must stand in the passage.

Passages are windows of two segments, a segment being as long as the longest item, so that
any occurrence of an item lies whole in a window. Document frequencies and mean length are
those of all items. Test sets are small next to a corpus; an index is built for a group of
items of bounded size, searched in one pass, and dropped before the next is built.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

WORD = re.compile(r"\w+")
K1, B = 1.2, 0.75
SHINGLE, SIMILARITY = 5, 0.8
BLOCK = 8


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence or line is the answer, the rest the question; a single sentence is all question."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n+", text or "") if WORD.search(p)]
    if len(parts) < 2:
        return words_of(text), []
    return words_of(" ".join(parts[:-1])), words_of(parts[-1])


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Five-word shingles; fewer words are one shingle, none give none."""
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's shingles that stand in the passage; an empty part is all there."""
    want = shingles(part)
    if not want:
        return 1.0
    n = min(len(part), SHINGLE)
    have = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return len(want & have) / len(want)


@dataclass
class Hit:
    row: int
    item_id: int
    score: float
    question: float
    answer: float


class Index:
    """BM25 postings of the items with block maxima; plain arrays, so it travels well."""

    def __init__(self, items: list[tuple[int, str]], share: float = 0.8, stats: "Statistics | None" = None):
        kept = [(i, t, words_of(t)) for i, t in sorted(items, key=lambda x: (x[0], x[1] or ""))]
        kept = [x for x in kept if x[2]]
        self.ids = [x[0] for x in kept]
        self.parts = [question_and_answer(x[1]) for x in kept]
        self.vocabulary: dict[str, int] = {}
        n = len(kept)
        self.segment = stats.longest if stats else max((len(x[2]) for x in kept), default=1)
        self.blocks = (n + BLOCK - 1) // BLOCK
        lengths = np.array([len(x[2]) for x in kept], float)
        rows: list[tuple[int, int, int]] = []
        for i, (_, _, words) in enumerate(kept):
            counts: dict[str, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            rows += [(self.vocabulary.setdefault(w, len(self.vocabulary)), i, c) for w, c in counts.items()]
        v = len(self.vocabulary)
        self.term, self.item, tf = (np.array(c) for c in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, int),) * 3
        df = np.bincount(self.term, minlength=v)
        of, among, mean = (n, df, lengths.mean() if n else 1.0) if stats is None else (stats.items, np.array([stats.df[w] for w in self.vocabulary], float), stats.mean)
        idf = np.log1p((of - among + 0.5) / (among + 0.5))
        norm = K1 * (1 - B + B * lengths / mean)
        weight = idf[self.term] * tf * (K1 + 1) / (tf + norm[self.item])
        self.own = np.bincount(self.item, weight, minlength=n)
        self.impact = weight / (share * self.own[self.item])
        self.share = share
        self.at = np.searchsorted(self.term, np.arange(v + 1))
        # Frequent terms are set aside while no item gets more than half its threshold from them.
        aside, self.aside = np.zeros(n), np.zeros(v, bool)
        for t in np.argsort(-df, kind="stable"):
            if df[t] < 2:
                break
            span = slice(self.at[t], self.at[t + 1])
            grown = aside[self.item[span]] + self.impact[span]
            if (grown <= 0.5).all():
                aside[self.item[span]] = grown
                self.aside[t] = True
        self.rest = np.zeros(self.blocks)
        np.maximum.at(self.rest, np.arange(n) // BLOCK, aside)
        # Block maxima: of all terms for WAND, of those not set aside for many passages at once.
        self.top = np.zeros(v)
        np.maximum.at(self.top, self.term, self.impact)
        keep = np.ones(len(self.term), bool)
        key, where = np.unique(self.term[keep] * max(1, self.blocks) + self.item[keep] // BLOCK, return_inverse=True)
        self.block_max = np.zeros(len(key))
        np.maximum.at(self.block_max, where, self.impact[keep])
        self.block_of = key % max(1, self.blocks)
        self.block_at = np.searchsorted(key // max(1, self.blocks), np.arange(v + 1))

    def search(self, texts: list[str | None], most: int | None = None) -> list[Hit]:
        """The best verified window of each (text, item); ``row`` is the text's position.

        At most 200,000 words or two million bounds are held at a time; a longer text is
        searched in pieces that overlap by a segment.
        """
        found: dict[tuple[int, int], Hit] = {}
        if self.blocks:
            most = most or max(1, min(2_000_000 // self.blocks, 200_000 // self.segment))  # segments
            held: list[tuple[int, list[str], np.ndarray, int]] = []
            segments = 0
            for row, text in enumerate(texts):
                words = words_of(text)
                for at in range(0, -(-len(words) // self.segment), most):
                    piece = words[at * self.segment : (at + most + 1) * self.segment]
                    windows = min(most, -(-len(piece) // self.segment))
                    if held and segments + windows + 2 > most:
                        self._open(held, found)
                        held, segments = [], 0
                    held.append((row, piece, np.fromiter(map(self.vocabulary.get, piece, repeat(-1)), np.int64, len(piece)), windows))
                    segments += windows + 2
            self._open(held, found)
        return list(found.values())

    def wand(self, terms: list[int], threshold: float = 1 - 1e-9) -> list[tuple[int, float]]:
        """(item, score) of all items that ``terms`` lift to ``threshold``, by block-max WAND."""
        lists = [[int(self.item[self.at[t]]), int(self.at[t]), int(self.at[t + 1]), t] for t in terms]  # item at the cursor, cursor, end, term
        found = []

        def advance(to: int, some: list) -> None:
            for x in some:
                x[1] += int(np.searchsorted(self.item[x[1] : x[2]], to))
                x[0] = int(self.item[x[1]]) if x[1] < x[2] else -1

        while lists:
            lists.sort()
            upper, pivot = 0.0, -1
            for i, x in enumerate(lists):
                upper += self.top[x[3]]
                if upper >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            ahead, block = lists[: pivot + 1], item // BLOCK
            if sum(self.block_bound(x[3], block) for x in ahead) < threshold:
                later = lists[pivot + 1][0] if pivot + 1 < len(lists) else (block + 1) * BLOCK
                advance(max(item + 1, min(later, (block + 1) * BLOCK)), ahead)
            elif lists[0][0] == item:
                score = float(sum(self.impact[x[1]] for x in ahead))
                if score >= threshold:
                    found.append((item, score))
                advance(item + 1, ahead)
            else:
                advance(item, [x for x in ahead if x[0] < item])
            lists = [x for x in lists if x[0] >= 0]
        return found

    def block_bound(self, term: int, block: int) -> float:
        """The term's largest impact in a block."""
        lo, hi = self.block_at[term], self.block_at[term + 1]
        at = lo + int(np.searchsorted(self.block_of[lo:hi], block))
        return float(self.block_max[at]) if at < hi and self.block_of[at] == block else 0.0

    def _open(self, held, found) -> None:
        if not held:
            return
        counts = np.array([-(-len(h[1]) // self.segment) for h in held])  # a piece may end with a segment of the next
        first = np.concatenate([[0], np.cumsum(counts + 1)])  # an empty segment parts the texts
        ids = np.concatenate([h[2] for h in held])
        place = np.concatenate([f + np.arange(len(h[1])) // self.segment for h, f in zip(held, first, strict=False)])
        live = ids >= 0
        live[live] = ~self.aside[ids[live]]
        v = len(self.vocabulary)
        pairs = np.unique(place[live] * v + ids[live])
        seg, term = pairs // v, pairs % v
        reach = self.block_at[term + 1] - self.block_at[term]
        at = np.repeat(self.block_at[term] - np.concatenate([[0], np.cumsum(reach)[:-1]]), reach) + np.arange(reach.sum())
        cell = np.repeat(seg, reach) * self.blocks + self.block_of[at]
        bound = np.bincount(cell, self.block_max[at], minlength=(int(first[-1]) + 1) * self.blocks).reshape(-1, self.blocks)
        windows, blocks = np.nonzero(bound[:-1] + bound[1:] + self.rest[None, :] >= 1 - 1e-9)
        for window in np.unique(windows):
            text = int(np.searchsorted(first, window, side="right")) - 1
            row, words, tokens, starts = held[text]
            k = int(window - first[text])
            if k >= starts:
                continue
            span = slice(k * self.segment, (k + 2) * self.segment)
            terms = np.unique(tokens[span])
            for i, score in self.wand(terms[terms >= 0].tolist()):
                q, a = (overlap(part, words[span]) for part in self.parts[i])
                score *= float(self.share * self.own[i])
                if q >= SIMILARITY and a >= SIMILARITY and ((row, i) not in found or score > found[row, i].score):
                    found[row, i] = Hit(row, self.ids[i], score, q, a)


@dataclass
class Statistics:
    """Of all items: their number, mean and largest length in words, and the items that hold a word."""

    items: int
    mean: float
    longest: int
    df: dict[str, int]


def item_groups(items: DataFrame, share: float = 0.8, group_rows: int = 20_000, group_bytes: int = 32 << 20) -> Iterator[tuple[Index, bool]]:
    """(index, is it the only one) for each group of at most ``group_rows`` items and about ``group_bytes`` bytes, one at a time.

    Repeated items and null or empty texts are left out. Groups are dealt by a hash, so
    each is collected alone and its size is known beforehand; with several groups the
    statistics of a group's words are read from counts over all items.
    """
    items = materialize(items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null and item_id is not null").distinct(), "items")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-n // group_rows), -(-size // group_bytes))
    if groups == 1:
        yield Index([(r.item_id, r.text) for r in items.collect()], share), True
        return

    def words(batches):
        for batch in batches:
            rows = [(w, int(at == 0), len(found)) for found in map(words_of, batch.column("text").to_pylist()) for at, w in enumerate(dict.fromkeys(found))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["word", "head", "length"])

    seen = materialize(items.select("text").mapInArrow(words, "word string, head long, length long"), "item-words")
    df = materialize(seen.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "item-df")
    count, mean, longest = seen.where("head = 1").agg(F.count(F.lit(1)), F.coalesce(F.avg("length"), F.lit(1.0)), F.coalesce(F.max("length"), F.lit(1))).first()
    groups *= 2  # leeway for uneven hashing
    dealt = items.withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    for g in range(groups):
        group = dealt.where(F.col("group") == g).select("item_id", "text")
        own = group.select("text").mapInArrow(words, "word string, head long, length long").select("word").distinct()
        stats = Statistics(count, mean, longest, {r.word: r.df for r in df.join(own, "word", "left_semi").collect()})  # the words of one group
        yield Index([(r.item_id, r.text) for r in group.collect()], share, stats), False


def contaminated(docs: DataFrame, items: DataFrame, share: float = 0.8, **groups) -> DataFrame:
    """(doc_id, item_id, bm25, question_overlap, answer_overlap), a row per document and item found in it.

    Null and empty texts hold no items; a row that is repeated gives its rows again.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    out = None
    for index, only in item_groups(items, share, **groups):

        def run(batches, index=index):
            for batch in batches:
                hits = index.search(batch.column("text").to_pylist())
                ids = batch.column("doc_id").take(pa.array([h.row for h in hits], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([h.item_id for h in hits], pa.int64()), *(pa.array([getattr(h, f) for h in hits], pa.float64()) for f in ("score", "question", "answer"))],
                    names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap"],
                )

        found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, item_id long, bm25 double, question_overlap double, answer_overlap double")
        found = found if only else materialize(found, "found")
        out = found if out is None else out.union(found)
    return out


def keep_clean(docs: DataFrame, items: DataFrame, share: float = 0.8, **groups) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no item is found. Texts are not shuffled.

    Null and empty texts stay, repeated rows stay repeated; without items every row stays.
    """
    hits = []
    for index, only in item_groups(items, share, **groups):

        def run(batches, index=index):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[h.row for h in index.search(batch.column("text").to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        def found(batches, index=index):
            for batch in batches:
                texts = batch.column("text").to_pylist()
                rows = sorted({h.row for h in index.search(texts)})
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(texts[r].encode()).hexdigest() for r in rows], pa.string())], names=["__hit"])

        if only:
            return docs.mapInArrow(run, docs.schema)
        hits.append(materialize(docs.select("text").mapInArrow(found, "__hit string"), "hits"))
    if not hits:
        return docs
    # The text decides, so hashes of the texts with hits are all that several groups leave behind.
    dirty = materialize(functools.reduce(DataFrame.union, hits).distinct(), "dirty")
    dirty = F.broadcast(dirty) if dirty.count() * 80 <= 64 << 20 else dirty
    return docs.join(dirty, F.md5(docs["text"]) == dirty["__hit"], "left_anti")
