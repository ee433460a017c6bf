"""Helpers shared by the training-data operators: scratch tables and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path, stored

__all__ = ["SPACE", "connected_components", "discard", "let", "materialize", "scratch_path", "unit_hash", "word_count"]

#: White space between words: space and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: lost executors cost a reread, never a recomputation, and
    identifiers drawn while writing stay as they are.
    """
    return stored(df, name)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that no later step reads, so that scratch disk holds what is in use only."""
    for table in tables:
        hadoop = table.sparkSession.sparkContext
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            where = hadoop._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(hadoop._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_hash(*cols: Column) -> Column:
    """A uniform double in [0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 200) -> DataFrame:
    """(node, root) with root the smallest node reachable, for every node of ``edges``.

    Each round takes the smallest label among a node's neighbours and then follows
    that label once (pointer jumping). Every round is a written table, so plans stay
    short. Edges come as spanning forests of blocks, hence few per node. Self-loops
    give a node of its own; null ends are dropped; an empty table gives none.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    both = materialize(pairs.union(pairs.select("b", "a")).distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "cc-labels")
    for _ in range(max_rounds):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node", "left").select("node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("mid"))
        step = lower.join(labels.select(F.col("node").alias("mid"), F.col("root").alias("jump")), "mid", "left").select(
            "node", "old", F.least("mid", F.coalesce("jump", "mid")).alias("root")
        )
        step, before = materialize(step, "cc-labels"), labels
        labels = step.select("node", "root")
        discard(before)
        if step.where("root < old").isEmpty():
            discard(both)
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
