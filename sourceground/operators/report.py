"""Counts for release statistics and run reports; all are partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def task_counts(items: DataFrame, *by: str) -> DataFrame:
    return items.groupBy(*by, "task_code").agg(F.count(F.lit(1)).alias("n"))


def task_map(items: DataFrame, by: str) -> DataFrame:
    """(by, by_task map): one entry for each task."""
    counts = task_counts(items, by)
    return counts.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("task_code", "n")))).alias("by_task"))


def grouped_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Counts by either column, in one pass: (dimension, value, n)."""
    sets = df.groupingSets([[first], [second]], first, second).agg(F.count(F.lit(1)).alias("n"), F.grouping(first).alias("__g"))
    value = F.when(F.col("__g") == 0, F.col(first)).otherwise(F.col(second))
    return sets.select(F.when(F.col("__g") == 0, first).otherwise(second).alias("dimension"), value.alias("value"), "n")


def books_covered(items: DataFrame) -> DataFrame:
    return items.agg(F.count_distinct("book_id").alias("books"))


def validation_totals(checked: DataFrame, *by: str) -> DataFrame:
    return checked.groupBy(*by).agg(F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))


def rejected_by_level(checked: DataFrame) -> DataFrame:
    return checked.where("not ok").groupBy("inference_level").agg(F.count(F.lit(1)).alias("n"))


def pilot_stats(corpus: DataFrame, sample: DataFrame, checked: DataFrame, released: DataFrame) -> DataFrame:
    """One row per pilot; every input has a column ``pilot``."""
    full = corpus.groupBy("pilot").agg(F.count(F.lit(1)).alias("passages_full"), F.count_if(F.size("formulas") > 0).alias("formula_passages"))
    some = sample.groupBy("pilot").agg(F.count(F.lit(1)).alias("passages_sampled"))
    made = checked.groupBy("pilot").agg(F.count(F.lit(1)).alias("items_generated"), F.count_if("ok").alias("items_valid"), F.count_if(~F.col("ok")).alias("items_failed"))
    out = released.groupBy("pilot").agg(F.count(F.lit(1)).alias("items_released"))
    joined = full.join(some, "pilot", "left").join(made, "pilot", "left").join(out, "pilot", "left")
    return joined.fillna(0)


def totals(stats: DataFrame) -> DataFrame:
    """Per pilot and over all (pilot null)."""
    return stats.rollup("pilot").agg(F.sum("items_generated").alias("items_generated"), F.sum("items_failed").alias("items_failed"))


def stats_document(stats: DataFrame, by_task: DataFrame, books: int | None = None, version: str = "") -> DataFrame:
    """One row with the statistics as one JSON document."""
    joined = stats.join(by_task, "pilot", "left")
    entry = F.struct("pilot", *[c for c in stats.columns if c != "pilot"], "by_task")
    by_name = lambda x, y: F.when(x["pilot"] < y["pilot"], -1).when(x["pilot"] > y["pilot"], 1).otherwise(0)
    body = F.array_sort(F.collect_list(entry), by_name).alias("pilots")  # one entry per pilot
    return joined.agg(body).select(F.to_json(F.struct(F.lit(version).alias("corpus_version"), F.lit(books).alias("books"), "pilots"), {"ignoreNullFields": "false"}).alias("value"))


def run_report(replies: DataFrame, checked: DataFrame, target: int) -> DataFrame:
    """One row: jobs, errors, unparsed replies, items, accepted, rejected, shortfall."""
    from .model import job_accounting

    parts = job_accounting(replies).unionByName(checked.agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected")), allowMissingColumns=True)
    names = ("jobs_total", "errored", "parse_failed", "yielded", "accepted", "rejected")
    row = parts.agg(*[F.max(c).alias(c) for c in names])  # two rows, one of each side
    return row.select(F.lit(target).alias("target"), *names, F.greatest(F.lit(0), F.lit(target) - F.col("accepted")).alias("shortfall"))
