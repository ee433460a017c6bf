"""A corpus pipeline: quality, near copies, benchmark leaks, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` stores each result
in the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sourceground.llm import decontaminate, mixing, near_copies, quality, sharding
from sourceground.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Shards of the corpus: what the mix takes depends on their number, so no setting of a cluster moves it.
SHARDS = 8

# Every stage keeps rows as they are: nulls in any column, empty and very long texts and repeated
# ids are rows like others, an empty table stays empty, and columns beside COLUMNS are dropped.


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts; all of them if labels of two classes are missing."""
    return quality.keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more.

    The first by doc_id stays, null ids last. Texts without words are one group; rows equal
    in all columns are one row; texts of their own stay under null and repeated ids.
    """
    return near_copies.keep_one(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; without items all of them. Null texts hold none."""
    return decontaminate.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each copy of a document that the mix takes. Null is a source."""
    return mixing.mixed_rows(docs.select(*COLUMNS), SHARDS)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its size and its place (shard, slot) in shards of near equal bytes."""
    return sharding.shard_rows(docs.select(*COLUMNS), SHARDS)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return docs


#: The classifier and the fingerprint groups are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None
