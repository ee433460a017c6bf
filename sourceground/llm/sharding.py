"""Contiguous, byte-balanced shards from global prefix sums (DataFrame functions only).

Rows are range-partitioned by their order columns. Each partition's total size gives
the partition's offset in the global prefix sum, a window inside the partition gives
each row's own start, and the global line is cut at equal targets. Only one row per
partition is ever brought together, so no task sees the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def contiguous_shards(df: DataFrame, size: str, order: list[str], num_shards: int, partitions: int | None = None) -> DataFrame:
    """``df`` with ``shard`` (0 to num_shards-1) and ``slot`` (gapless from 0 in a shard).

    ``df`` must not hold columns named ``shard``, ``slot`` or starting with ``__``.
    A row belongs to the shard that holds the middle of its bytes, so a shard is off its
    target by at most one row. Sizes must be positive. Nulls in the order columns come
    first; rows that agree in all order columns stay in some fixed order, decided once
    when the numbered table is written. An empty table gives an empty result. Rows
    repeated any number of times are spread like others.
    """
    if num_shards < 1:
        raise ValueError("num_shards must be positive")
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "__row"]
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    ranged = materialize(numbered.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()), "shard-ranges")

    placed = materialize(_placed(ranged, size, keys, num_shards).select(*df.columns, "shard", "__index"), "shard-placed")
    return _with_slot(placed, placed, num_shards).select(*df.columns, "shard", "slot")


def _placed(ranged: DataFrame, size: str, keys: list[str], num_shards: int) -> DataFrame:
    """Adds ``shard`` and the global ``__index`` to rows numbered by ``__part`` and, inside a part, by ``keys``."""
    # One row for each partition: their number is a setting, not a property of the data.
    totals = ranged.groupBy("__part").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__byte_offset"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__row_offset"),
        F.sum("bytes").over(everything).alias("__total"),
    )
    inside = Window.partitionBy("__part").orderBy(*keys)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(F.broadcast(offsets), "__part")
        .withColumn("__end", F.col("__byte_offset") + F.sum(size).over(upto))
        .withColumn("__index", F.col("__row_offset") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.expr(f"cast(least({num_shards - 1}, ((2 * __end - {size}) * {num_shards}) div (2 * __total)) as int)"))
    )


def _with_slot(rows: DataFrame, counted: DataFrame, num_shards: int) -> DataFrame:
    firsts = counted.groupBy("shard").agg(F.min("__index").alias("__first"))  # one row for each shard
    return rows.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("__index") - F.col("__first"))


def shard_rows(docs: DataFrame, num_shards: int = 8) -> DataFrame:
    """``docs`` with all their columns, ``size``, ``shard`` and ``slot``: shards of near equal bytes in the order in which rows come.

    Columns of these names are replaced. Rows are numbered while they are written once.
    A row's number holds the task that wrote it and its place there, so with the rows'
    offsets of each part it gives the global index, and the shards' first numbers, found on
    thin rows, give the shard: no text is shuffled. Null texts count as empty; repeated rows
    and ids are rows like others; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    numbered = docs.select(*kept, utf8_size(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("__row"))
    numbered = materialize(numbered, "shard-rows").withColumn("__part", F.shiftright("__row", 33))
    thin = materialize(_placed(numbered.select("__part", "__row", "size"), "size", ["__row"], num_shards).select("__part", "__row", "shard", "__index"), "shard-placed")
    parts = thin.groupBy("__part").agg((F.min_by("__index", "__row") - F.min("__row")).alias("__offset"))  # one row for each part
    firsts = thin.groupBy("shard").agg(F.min("__row").alias("row"), F.min("__index").alias("index")).orderBy("row").collect()  # at most num_shards rows
    if not firsts:
        return _with_slot(thin, thin, num_shards).join(numbered.drop("__part"), "__row").select(*kept, "size", "shard", "slot")
    cuts = F.array(*(F.struct(F.lit(r.row).alias("row"), F.lit(r.shard).alias("shard"), F.lit(r["index"]).alias("index")) for r in firsts))
    own = F.element_at(F.filter(cuts, lambda c: c["row"] <= F.col("__row")), -1)
    placed = numbered.join(F.broadcast(parts), "__part").withColumn("__cut", own)
    return placed.select(*kept, "size", F.col("__cut.shard").alias("shard"), (F.col("__row") + F.col("__offset") - F.col("__cut.index")).alias("slot"))


def shard_documents(docs: DataFrame, num_shards: int = 8) -> DataFrame:
    """Place documents into shards of near equal bytes, in the order of their ids.

    Only ids, sizes and checksums travel; texts are read once and never shuffled.
    Null texts count as empty. Rows with equal ids are ordered by checksum and size.
    """
    thin = docs.select(
        "doc_id",
        utf8_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    placed = contiguous_shards(thin, "size", ["doc_id", "text_crc32", "size"], num_shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
