"""Merkle manifest of a dataset, with octopus multiproofs.

1. Leaves: a row's hash over its length-prefixed fields (column functions). Rows are range
   partitioned by (lang, doc_id); totals of the partitions give every leaf its place.
2. Levels: eight consecutive nodes of a tree are one node of the next level, one small
   group each, until each tree has one node. Each lang is a tree; the langs' roots are
   the leaves of one more tree.
3. Proofs: leaves lie in parts of consecutive places. A part's multiproof is the smallest
   set of nodes that it cannot derive itself: siblings that no leaf of the part lies below.
   Their coordinates are joined with the stored nodes once; the part then derives the
   interiors that its leaves share and reads every single proof off them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Nodes under one node, and leaves in a part.
FAN, PART = 8, 512
#: The tree over the langs' roots; the others are numbered by their langs' order.
TOP = -1


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(stored: DataFrame, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """A stored table, broadcast while its rows are proven to stay under ``limit`` bytes."""
    return F.broadcast(stored) if stored.count() * row_bytes <= limit else stored


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``, gapless from 0 in the order of ``order`` (nulls first; equal rows in some fixed order)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = materialize(rows.withColumn("__own", F.monotonically_increasing_id()), name)
    ranged = fixed.repartitionByRange(parts, *order, "__own").sortWithinPartitions(*order, "__own").drop("__own")
    ranged = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), name).withColumn("__part", F.shiftright("__at", 33))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))  # one row for each partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__offset"))
    return ranged.join(F.broadcast(offsets), "__part").withColumn("place", F.col("__at") + F.col("__offset")).drop("__part", "__at", "__offset")


def manifest_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered) for every row; ``tampered`` is null where the row is not tampered with.

    A row is tampered with where 3 divides the crc32 of its doc_id as text (a null id counts
    as empty); then the A-Z of its text are lower-cased before hashing.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 0
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf_hash(*fields, F.col("text")).alias("leaf"), F.when(hit, leaf_hash(*fields, ascii_lower(F.col("text")))).alias("tampered"))


def placed_leaves(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with ``place``, ``tree``, ``idx`` and ``n``; trees). A lang is one tree of ``n`` leaves; trees follow the langs' order."""
    rows = materialize(numbered(leaves, ["lang", "doc_id", "leaf"], "merkle-leaves"), "merkle-placed")
    langs = rows.groupBy("lang").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = materialize(numbered(langs, ["lang"], "merkle-langs").withColumnRenamed("place", "tree"), "merkle-trees")
    # Langs are joined null-safe; one lang may hold most rows, and its few rows here are sent to all of them.
    found = rows.join(small(trees.withColumnRenamed("lang", "__lang"), 200), F.col("lang").eqNullSafe(F.col("__lang"))).drop("__lang")
    return materialize(found.withColumn("idx", F.col("place") - F.col("first")).drop("first", "lang"), "merkle-indexed"), trees


def build_levels(leaves: DataFrame, name: str, fan: int = FAN) -> DataFrame:
    """(tree, level, idx, node, n) of all levels above ``leaves`` (tree, idx, node, n); ``n`` counts the nodes of the tree's level.

    Level by level, each from the stored one below it; a group is one run of ``fan`` nodes at most.
    """
    level = leaves.select("tree", F.lit(0).alias("level"), "idx", "node", "n")
    spark, levels = leaves.sparkSession, []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        run = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "node"))), lambda x: x["node"]), "")
        grouped = level.where("n > 1").groupBy("tree", "level", F.expr(f"idx div {fan}").alias("up"), "n").agg(F.sha2(run, 256).alias("node"))
        level = materialize(grouped.select("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"), "node", F.expr(f"(n + {fan - 1}) div {fan}").alias("n")), name)
        levels.append(level)
        most = -(-most // fan)
    out = spark.createDataFrame([], "tree long, level int, idx long, node string, n long")
    for level in levels:
        out = out.union(level)
    return out


def subroots(leaves: DataFrame, levels: DataFrame) -> DataFrame:
    """(tree, node): the one node that remains of each tree; a lone leaf is its own."""
    return leaves.where("n = 1").select("tree", "node").union(levels.where("n = 1").select("tree", "node"))


def missing(known: np.ndarray, n: int, fan: int = FAN) -> list[tuple[int, np.ndarray]]:
    """(level, places) of the smallest set of nodes from which, with the leaves ``known`` of a tree of ``n``, its root follows.

    On each level the siblings of known nodes that are not known themselves; their parents
    are known on the next.
    """
    out, level, known = [], 0, np.unique(known)
    while n > 1:
        runs = np.unique(known // fan)
        all_ = (runs[:, None] * fan + np.arange(fan)).ravel()
        out.append((level, np.setdiff1d(all_[all_ < n], known, assume_unique=True)))
        known, n, level = runs, -(-n // fan), level + 1
    return out


def climb(nodes: dict[int, str], fetched: dict[tuple[int, int], str], n: int, fan: int = FAN) -> list[dict[int, str]]:
    """The known nodes of every level of a tree of ``n`` leaves, from known leaves and fetched nodes: shared interiors once."""
    levels, level = [], 0
    while n > 1:
        own = nodes | {at: node for (lv, at), node in fetched.items() if lv == level}
        levels.append(own)
        nodes = {run: digest("".join(own[at] for at in range(run * fan, min(run * fan + fan, n)))) for run in {at // fan for at in nodes}}
        n, level = -(-n // fan), level + 1
    return [*levels, nodes]


def path(levels: list[dict[int, str]], idx: int, n: int, fan: int = FAN) -> list[tuple[list[str], list[str]]]:
    """For each level the siblings left and right of the leaf ``idx``'s ancestor, read off the known nodes."""
    out = []
    for own in levels[:-1]:
        first = idx - idx % fan
        out.append(([own[k] for k in range(first, idx)], [own[k] for k in range(idx + 1, min(first + fan, n))]))
        idx, n = idx // fan, -(-n // fan)
    return out


def fold(leaf: str, proof: list[tuple[list[str], list[str]]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for left, right in proof:
        leaf = digest("".join((*left, leaf, *right)))
    return leaf


def multiproof_coordinates(leaves: DataFrame, langs: int) -> DataFrame:
    """(part, tree, level, idx) of the nodes that each part of ``leaves`` (part, tree, idx, n) lacks; ``langs`` trees stand below the top."""

    def search(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [pd.DataFrame({"tree": tree, "level": level, "idx": places}) for tree, own in pdf.groupby("tree") for level, places in missing(own["idx"].to_numpy(), int(own["n"].iloc[0]))]
        rows += [pd.DataFrame({"tree": TOP, "level": level, "idx": places}) for level, places in missing(pdf["tree"].to_numpy(), langs)]
        found = pd.concat([r for r in rows if len(r)] or [pd.DataFrame({"tree": [], "level": [], "idx": []})])
        return found.assign(part=key[0])[["part", "tree", "level", "idx"]]

    return leaves.select("part", "tree", "idx", "n").groupBy("part").applyInPandas(search, "part long, tree long, level int, idx long")


def expand(leaves: DataFrame, fetched: DataFrame, langs: int) -> DataFrame:
    """Every leaf with its proof and its folds: (doc_id, leaf, subroot, root, proof_sha256, folded_root).

    ``leaves`` holds (part, doc_id, tree, idx, n, leaf, tampered), ``fetched`` the nodes (part,
    tree, level, idx, node) of the parts' multiproofs. ``root`` follows from the part alone.
    """

    def prove(own: pa.Table, nodes: pa.Table) -> pa.Table:
        held: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, idx, node in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "idx", "node")), strict=True):
            held.setdefault(tree, {})[level, idx] = node
        rows = list(zip(*(own.column(c).to_pylist() for c in ("tree", "idx", "n", "leaf", "tampered")), strict=True))
        known: dict[int, tuple[int, dict[int, str]]] = {}
        for tree, idx, n, leaf, _ in rows:
            known.setdefault(tree, (n, {}))[1][idx] = leaf
        trees = {tree: climb(nodes_, held.get(tree, {}), n) for tree, (n, nodes_) in known.items()}
        tops = {tree: next(iter(levels[-1].values())) for tree, levels in trees.items()}
        top = climb(tops, held.get(TOP, {}), langs)
        root = next(iter(top[-1].values()))
        above = {tree: path(top, tree, langs) for tree in tops}
        proofs, folds = [], []
        for tree, idx, n, leaf, tampered in rows:
            proof = path(trees[tree], idx, n) + above[tree]
            proofs.append(digest("".join(s for left, right in proof for s in (*left, *right))))
            folds.append(fold(tampered or leaf, proof))
        told = {"subroot": [tops[r[0]] for r in rows], "root": [root] * len(rows), "proof_sha256": proofs, "folded_root": folds}
        return pa.table({"doc_id": own.column("doc_id"), "leaf": own.column("leaf")} | {k: pa.array(v, pa.string()) for k, v in told.items()})

    doc_type = leaves.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    own = leaves.select("part", "doc_id", "tree", "idx", "n", "leaf", "tampered")
    return own.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(prove, schema)


def manifest(docs: DataFrame, part: int = PART) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    ``verified`` holds the folded root against the root of the built trees. Null fields are
    hashed as ``-``; a null lang is a tree of its own, the first; of equal ids the smaller
    leaf comes first, and rows equal in all fields take neighbouring places; columns beside
    the five hashed ones are not read; an empty table gives an empty result.
    """
    rows, trees = placed_leaves(manifest_leaves(docs))
    leaves = rows.withColumnRenamed("leaf", "node")
    below = build_levels(leaves, "merkle-level")
    langs = trees.count()
    tops = materialize(subroots(leaves, below).select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "node", F.lit(langs).cast("long").alias("n")), "merkle-subroots")
    above = build_levels(tops, "merkle-top")
    root = tops.where("n = 1").select("node").union(above.where("n = 1").select("node")).first()
    nodes = leaves.select("tree", F.lit(0).alias("level"), "idx", "node").union(below.select("tree", "level", "idx", "node"))
    nodes = nodes.union(tops.select("tree", F.lit(0).alias("level"), "idx", "node")).union(above.select("tree", "level", "idx", "node"))

    parted = rows.withColumn("part", F.expr(f"place div {part}"))
    wanted = materialize(multiproof_coordinates(parted, langs), "merkle-coordinates")
    fetched = materialize(nodes.join(small(wanted, 40), ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "node"), "merkle-fetched")
    return expand(parted, fetched, langs).withColumn("verified", F.col("folded_root") == F.lit(root[0] if root else None))
