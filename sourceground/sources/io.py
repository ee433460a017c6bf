"""Item and corpus tables as JSON lines; Parquet between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a declared schema; blank lines are skipped, a broken line fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """(passage_id, task_code) of what an earlier run has written; half-written lines are skipped."""
    rows = spark.read.schema("passage_id string, task_code string").option("mode", "DROPMALFORMED").json(path)
    return rows.where("passage_id is not null and task_code is not null").distinct()


def with_answer(items: DataFrame) -> DataFrame:
    """One ``answer`` column of any JSON shape from the typed ones."""
    text = F.to_json(F.to_variant_object(F.array("answer_text")))  # quotes and escapes
    quoted = F.regexp_extract(text, r"(?s)^\[(.*)\]$", 1)
    formula = F.to_json("answer_formula", {"ignoreNullFields": "false"})
    json = F.coalesce(F.when(F.col("answer_text").isNotNull(), quoted), formula, F.col("answer_json"))
    return items.withColumn("answer", F.parse_json(json)).drop("answer_text", "answer_formula", "answer_json")


def write_jsonl(df: DataFrame, path: str, *partition_by: str, mode: str = "overwrite") -> None:
    """Non-ASCII text as it is, null fields written."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row document."""
    df.coalesce(1).write.mode("overwrite").text(path)
