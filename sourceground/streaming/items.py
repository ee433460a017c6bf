"""Items from a growing corpus: each passage is turned into checked items once."""

from __future__ import annotations

import functools
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import generate, validate
from ..sources.scratch import exists


def stream_items(spark: SparkSession, corpus_path: str, schema: StructType, tasks: list[str], max_files: int | None = None) -> DataFrame:
    """Checked items of every corpus file that arrives below ``corpus_path`` (Parquet); stateless, so it needs no watermark."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)  # bounds the work in flight
    return validate.generate_and_validate(reader.parquet(corpus_path), tasks)


def write_items(items: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append accepted items as they come; a rerun on the same checkpoint adds nothing."""
    return items.where("ok").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def write_new_items(items: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """As ``write_items``, without items whose passage and task the sink has: an anti-join for each batch, so no state grows.

    Of the sink only the two key columns are read. An item that a batch holds twice is
    written once. A batch that is run again replaces what it wrote before, in a folder
    named by checkpoint and batch.
    """
    run = f"run={zlib.crc32(checkpoint.encode()):08x}"

    def add(batch: DataFrame, number: int) -> None:
        session, mine = batch.sparkSession, f"{out}/{run}/batch={number}"
        fresh = batch.where("ok").dropDuplicates(["item_id"])
        if exists(session, out):
            done = session.read.schema("passage_id string, task_code string, run string, batch long").option("basePath", out).parquet(out)
            fresh = generate.resume(fresh, done.where((F.concat(F.lit("run="), "run") != run) | (F.col("batch") != number)))
        fresh.write.mode("overwrite").parquet(mine)

    return items.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_keyed_items(spark: SparkSession, corpus_path: str, schema: StructType, tasks: list[str], retention: str = "30 days", max_files: int | None = None) -> DataFrame:
    """As ``stream_items``, with each passage and task once: keys are state, so the sink is never read.

    A key is forgotten ``retention`` after its passage was first seen; a passage that arrives
    again later than that is made into items again. Time is when a batch runs, so no row
    is ever late. Run with ``write_keyed_items``, whose checkpoint holds the state.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    passages = reader.parquet(corpus_path).withColumn("__seen", F.current_timestamp()).withWatermark("__seen", retention)
    made = []
    for task in tasks:
        fresh = passages.where(F.array_contains("candidate_tasks", task)).dropDuplicatesWithinWatermark(["passage_id"])
        made.append(validate.generate_and_validate(fresh, [task]))
    return functools.reduce(DataFrame.unionByName, made)


def write_keyed_items(items: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """``write_items`` with its keys in RocksDB, so that state is bounded by disk, not by memory."""
    conf, name = items.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return write_items(items, out, checkpoint)  # the query keeps the settings with which it starts
    finally:
        conf.set(name, before) if before else conf.unset(name)
