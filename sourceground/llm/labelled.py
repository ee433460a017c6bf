"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32(doc_id as text) leaves ``remainder``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus)) == remainder


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` documents of each class, and the class sizes among all labels that may be learnt from.

    The bound keeps the rows with the smallest hash of their id, so it is a uniform
    sample and reruns agree. Labels of the held-out fold are never read further than
    this filter. Null labels and ids are left out; of an id with several labels the
    largest counts, of an id with several documents one (the smallest hash of its columns).
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    usable = usable.where(~held_out(F.col("doc_id"), modulus, remainder)).groupBy("doc_id").agg(F.max("y").alias("y"))
    usable = materialize(usable, "labels")
    sizes = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    key = F.xxhash64("doc_id")
    picked = usable.where("y = 0").orderBy(key, "doc_id").limit(per_class).union(usable.where("y = 1").orderBy(key, "doc_id").limit(per_class))
    picked = picked.withColumnRenamed("doc_id", "__id")  # 2 * per_class rows at most
    rest = [c for c in docs.columns if c != "doc_id"]
    rows = docs.join(F.broadcast(picked), docs.doc_id == F.col("__id")).groupBy("doc_id").agg(F.min_by(F.struct("y", *rest), F.xxhash64(*rest)).alias("x")).select("doc_id", "x.*")
    return materialize(rows, "labelled"), {0: sizes.get(0, 0), 1: sizes.get(1, 0)}
