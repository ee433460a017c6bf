"""SimHash near-duplicate groups, found with vantage-point trees under Hamming distance.

1. Every document gets a 64-bit fingerprint of its word shingles (Arrow batches).
2. Distinct fingerprints are routed down a vantage-point tree: a fingerprint is a member
   of one leaf, and visits each further leaf whose ball could hold a partner within the
   radius (triangle inequality). The tree is fitted on a bounded sample; that moves
   only the boundaries, never the result.
   Each level copies about a third of the rows, so the tree stops at a stated number of
   copies; a leaf that is still too large is cut into groups that agree in part of their bits.
3. Each leaf or such group is one task's work: a deeper tree inside it prunes the same way and compares the
   few that remain exactly. A leaf returns a spanning forest of its links, not all pairs.
4. Components of these links, then the smallest document id of each.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize

SEED = 42
SHINGLE = 3
#: Members wanted in a leaf, and fingerprints (of any number of them) that fit the tree's boundaries.
LEAF_MEMBERS = 8192
SAMPLE = 16384
#: Levels of the tree at most, and rows of all leaves for each fingerprint at most, as its sample tells.
DEPTH, COPIES = 10, 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash: a bit is set if set in over half of the shingle hashes.

    A-Z is lowered, words are runs without ASCII white space. Fewer words than a shingle
    needs: the whole sequence is the only shingle. No words (or null): 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(
        b"".join([digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]), np.uint8
    ).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65535):  # bounded memory for very long texts; a block's counts fit 16 bits
        counts += np.unpackbits(hashes[at : at + 65535], axis=1).sum(axis=0, dtype=np.uint16)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs``; other columns are not read."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, fp long")


def hamming(x, y):
    return np.bitwise_count(np.bitwise_xor(x, y))


class VantageTree:
    """Balls around vantage points; ``route`` tells where members live and whom they visit."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int):
        self.depth, self.radius = depth, radius
        self.points, self.bounds = np.zeros(2**depth, np.uint64), np.zeros(2**depth, np.int64)
        self._fit(1, np.unique(sample), depth)

    def _fit(self, node: int, values: np.ndarray, depth: int) -> None:
        if not depth:
            return
        if len(values):
            self.points[node] = values[len(values) // 2]
            d = hamming(values, self.points[node]).astype(np.int64)
            self.bounds[node] = int(np.median(d))
            self._fit(2 * node, values[d <= self.bounds[node]], depth - 1)
            self._fit(2 * node + 1, values[d > self.bounds[node]], depth - 1)
        else:
            self.bounds[node] = 64

    def route(self, fps: np.ndarray, member: np.ndarray | None = None):
        """Arrays (leaf, fingerprint, member). Of two partners in different leaves, the one that turned left visits the other."""
        node, who, member = np.ones(len(fps), np.int64), fps, np.ones(len(fps), bool) if member is None else member
        for _ in range(self.depth):
            d = hamming(who, self.points[node]).astype(np.int64)
            bound = self.bounds[node]
            left = np.where(member, d <= bound, d - self.radius <= bound)
            right = np.where(member, d > bound, d + self.radius > bound)
            visits = member & (d <= bound) & (d + self.radius > bound)
            node = np.concatenate([2 * node[left], 2 * node[right] + 1, 2 * node[visits] + 1])
            member = np.concatenate([member[left], member[right], np.zeros(int(visits.sum()), bool)])
            who = np.concatenate([who[left], who[right], who[visits]])
        return node - 2**self.depth, who, member


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable over the links (a, b), for 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def leaf_links(members: np.ndarray, visitors: np.ndarray, radius: int, small: int = 256):
    """A spanning forest (x, y) of all pairs within ``radius`` that have a member at one end."""
    fps = np.concatenate([members, visitors])
    stack = [(np.arange(len(members)), np.arange(len(members), len(fps)))]
    found_a, found_b, held = [], [], 0
    root = np.arange(len(fps))

    def fold() -> None:
        nonlocal root, held
        if held:
            root = forest(np.concatenate([*found_a, np.arange(len(fps))]), np.concatenate([*found_b, root]), len(fps))
            found_a.clear()
            found_b.clear()
            held = 0

    while stack:
        own, guests = stack.pop()
        if not len(own):
            continue
        cut = None
        if len(own) > small:
            d = hamming(fps[own], fps[own[len(own) // 2]]).astype(np.int64)
            bound = int(np.median(d))
            if (d > bound).sum() == 0:
                bound -= 1
            if 0 < (d <= bound).sum() < len(own):
                cut = bound
        if cut is None:
            all_ = np.concatenate([own, guests])
            step = max(1, 2_000_000 // len(own))
            for at in range(0, len(all_), step):
                rows = all_[at : at + step]
                i, j = np.nonzero(hamming(fps[rows][:, None], fps[own][None, :]) <= radius)
                x, y = rows[i], own[j]
                keep = x != y
                if keep.any():
                    found_a.append(x[keep])
                    found_b.append(y[keep])
                    held += int(keep.sum())
                if held > 2_000_000:
                    fold()
            continue
        dg = hamming(fps[guests], fps[own[len(own) // 2]]).astype(np.int64)
        inner, outer = own[d <= cut], own[d > cut]
        stack.append((inner, guests[dg - radius <= cut]))
        stack.append((outer, np.concatenate([guests[dg + radius > cut], own[(d <= cut) & (d + radius > cut)]])))
    fold()
    linked = np.nonzero(root != np.arange(len(fps)))[0]
    return fps[linked], fps[root[linked]]


def _drawn(fps: DataFrame, of: int, wanted: int) -> np.ndarray:
    """About ``wanted`` of ``of`` fingerprints, by their hash."""
    every = max(1, -(-of // wanted))
    return fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").toArrow().column("fp").to_numpy().view(np.uint64)


def fitted(sample: np.ndarray, members: int, radius: int) -> VantageTree:
    """The deepest tree wanted for so many members whose leaves hold at most ``COPIES`` rows for each of ``sample``."""
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(1, members / LEAF_MEMBERS))))))
    while True:
        tree = VantageTree(sample, depth, radius)
        if not depth or len(tree.route(np.unique(sample))[0]) <= COPIES * len(np.unique(sample)):
            return tree
        depth -= 1


def parted(mask: int, radius: int) -> list[int]:
    """Masks that add bits to ``mask``: any two fingerprints within ``radius`` that agree under ``mask`` agree under one of them.

    The bits that are free yet fall into radius + 1 parts; two that differ in ``radius`` bits agree in one.
    """
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in part) for part in np.array_split(free, radius + 1)]


def route(fps: DataFrame, radius: int) -> DataFrame:
    """(leaf long, fp, member): each fingerprint where it lives and where it visits.

    The tree stops where visits would copy too much. Leaves with over four times the rows
    wanted, visitors among them, are cut by what their fingerprints hold under each mask of
    ``parted``, in as many groups as the size asks for; groups of one common value are cut
    again. Fingerprints are distinct, so 15 free bits fit, whatever the data. Two partners
    in a leaf share at least one of its groups.
    """
    n = fps.count()
    tree = fitted(_drawn(fps, n, SAMPLE), n, radius)

    def first(batches):
        for batch in batches:
            leaf, who, member = tree.route(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(who.view(np.int64)), pa.array(member)], names=["leaf", "fp", "member"])

    def again(batches):
        for batch in batches:
            mask = batch.column("mask").to_numpy()
            for old in np.unique(mask):
                rows = batch.filter(pa.array(mask == old))
                for new in parted(int(old) % 2**64, radius):
                    yield rows.set_column(1, "mask", pa.array(np.full(len(rows), new, np.uint64).view(np.int64)))

    routed = fps.select("fp").mapInArrow(first, "leaf long, fp long, member boolean").select("leaf", F.lit(0).cast("long").alias("mask"), "fp", "member")
    routed, done = materialize(routed, "simhash-routed"), []
    limit = 4 * LEAF_MEMBERS
    while True:
        sizes = routed.groupBy("leaf", "mask").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > limit) & (F.bit_count("mask") < 64 - int(np.log2(limit))))
        big = materialize(sizes.select("leaf", F.ceil(F.col("n") / LEAF_MEMBERS).alias("groups")), "simhash-big")
        leaves = big.count()
        if not leaves:
            return functools.reduce(DataFrame.union, done, routed).select("leaf", "fp", "member")
        few = F.broadcast(big) if leaves * 40 <= 64 << 20 else big  # else a shuffled join
        done.append(routed.join(few, "leaf", "left_anti"))
        cut = routed.join(few, "leaf").select("leaf", "mask", "fp", "member", "groups").mapInArrow(again, "leaf long, mask long, fp long, member boolean, groups long")
        group = F.xxhash64("leaf", "mask", F.pmod(F.xxhash64(F.col("fp").bitwiseAND(F.col("mask"))), F.col("groups")))
        routed = materialize(cut.select(group.alias("leaf"), "mask", "fp", "member"), "simhash-routed")


def hamming_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``fp`` within ``radius``.

    ``fps`` holds each fingerprint once. Empty input gives no links.
    """

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, member = pdf["fp"].to_numpy().view(np.uint64), pdf["member"].to_numpy(bool)
        a, b = leaf_links(np.sort(fp[member]), np.sort(fp[~member]), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return route(fps, radius).groupBy("leaf").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id reachable over near copies.

    Documents link if their fingerprints differ in at most ``radius`` bits; empty and
    null texts have fingerprint 0 and link like any other. Rows that repeat a doc_id are
    kept as they are. A null doc_id is never the smallest unless its group has no other
    (then component_id is null). An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, shingle), "simhash")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-distinct")
    roots = connected_components(materialize(hamming_links(distinct, radius), "simhash-links"))
    grouped = materialize(
        distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root")),
        "simhash-roots",
    )
    smallest = grouped.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_fp = grouped.join(smallest, "root").select(F.col("fp").alias("__fp"), "component_id")
    return prints.join(by_fp, prints.fp == by_fp["__fp"]).select("doc_id", "fp", "component_id")
