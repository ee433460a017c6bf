"""Mix sources to target weights with a hypergeometric splitting tree (DataFrame functions only).

Each source's documents are dealt into blocks of bounded size by a seeded hash. A target
is met by whole copies of the source plus, for the rest, whole blocks in the order of a
seeded permutation and single documents of the blocks around the rest's end. The exact number of
block copies that a source gives is its quota. A binary tree over the output shards
splits all quotas from the root down: at each node the left half's share of every source
is one draw of a multivariate hypergeometric law, so quotas add up exactly and every
shard's mixture is that of a uniform shuffle. Each source's permuted block copies are
then cut at the shards' quotas (disjoint by construction), and a shard is shuffled locally.

Sources are a configuration: there are few of them, each with a weight. Tables with one
row per source are the only ones ordered as a whole or broadcast; ``max_sources`` checks it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, materialize, unit_hash, word_count

WEIGHTS = (5, 2, 1)


def source_targets(stats: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Adds ``target`` to (source, source_size): weights repeat over sources by code point, null last.

    All targets together are ``share`` of all sizes. A target stops at ``cap`` times its
    source's size; the excess goes to the others by weight until none is above. This is
    the level L with sum(min(weight * L, cap * size)) = total, found by adding sources in
    the order in which they reach their cap. ``cap`` below ``share`` leaves all at their cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = stats.withColumn("__w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    fill = Window.orderBy((F.col("source_size") / F.col("__w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ranked.withColumn("__all", F.sum("source_size").over(whole))
        .withColumn("__capped", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("__open", F.sum("__w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("__level", (F.col("__all") * share - F.col("__capped") * cap) / F.col("__open"))
        .withColumn("__fits", F.col("__level") * F.col("__w") <= F.col("source_size") * cap)
        .withColumn("__found", F.min(F.when(F.col("__fits"), F.struct("__capped", "__level"))).over(whole))
    )
    target = F.least(F.col("source_size") * F.lit(float(cap)), F.coalesce(F.col("__found.__level") * F.col("__w"), F.col("source_size") * F.lit(float(cap))))
    return level.select("source", "source_size", "docs", target.alias("target"))


def _draw(u: Column, good: Column, total: Column, draws: Column) -> Column:
    """Hypergeometric draw by inversion: of ``draws`` taken from ``total``, how many are ``good``.

    Outcomes are visited from the mode upwards, then downwards, with weights relative to
    the mode's; beyond ten standard deviations their weight is below rounding.
    """

    def ratio(k):  # p(k + 1) / p(k)
        return (good - k) * (draws - k) / ((k + 1.0) * (total - good - draws + k + 1.0))

    low = F.greatest(F.lit(0).cast("long"), draws - (total - good))
    high = F.least(draws, good)
    mode0 = F.floor((draws + 1.0) * (good + 1.0) / (total + 2.0))
    spread = F.ceil(10 * F.sqrt(draws * (good / F.greatest(total, F.lit(1))) * (1 - good / F.greatest(total, F.lit(1))))) + 20

    def steps(n):
        return F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<bigint>"))

    def from_mode(mode):
        def weighed(reach):
            up, down = reach["up"], reach["down"]

            def add(next_weight):
                return lambda acc, i: let(acc["w"] * next_weight(i), lambda w: F.struct(w.alias("w"), (acc["s"] + w).alias("s")))

            zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))
            rise = lambda i: ratio(mode + i - 1)
            fall = lambda i: 1.0 / ratio(mode - i)
            total_w = 1.0 + F.aggregate(steps(up), zero, add(rise))["s"] + F.aggregate(steps(down), zero, add(fall))["s"]

            def walk(next_weight, sign):
                def step(acc, i):
                    def moved(w):
                        left = acc["left"] - w
                        hit = (acc["left"] > 0) & (left <= 0)
                        return F.struct(w.alias("w"), left.alias("left"), F.when(hit, mode + sign * i).otherwise(acc["pick"]).alias("pick"))

                    return let(acc["w"] * next_weight(i), moved)

                return step

            start = F.struct(F.lit(1.0).alias("w"), (u * total_w - 1.0).alias("left"), mode.alias("pick"))
            return let(
                F.aggregate(steps(up), start, walk(rise, 1)),
                lambda a: F.aggregate(steps(down), F.struct(F.lit(1.0).alias("w"), a["left"].alias("left"), a["pick"].alias("pick")), walk(fall, -1))["pick"],
            )

        return let(F.struct(F.least(high - mode, spread).alias("up"), F.least(mode - low, spread).alias("down")), weighed)

    return let(F.least(high, F.greatest(low, mode0)).cast("long"), from_mode)


def split_quotas(quotas: DataFrame, num_shards: int, seed: int) -> DataFrame:
    """(source, upto array<long>): for each shard, how many of the source's block copies lie in it or before it.

    ``quotas`` has (source, quota), one row per source. ``seed`` decides all draws.
    """
    item = "array<struct<source:string,q:bigint>>"
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("source", F.col("quota").alias("q")))).cast(item).alias("qs")).select(
        F.lit(0).alias("lo"), F.lit(num_shards).alias("hi"), "qs"
    )
    for _ in range(math.ceil(math.log2(num_shards)) if num_shards > 1 else 0):
        mid = F.expr("lo + (hi - lo + 1) div 2")
        total = F.aggregate("qs", F.lit(0).cast("long"), lambda a, x: a + x["q"])
        nodes = nodes.withColumn("mid", F.when(F.col("hi") - F.col("lo") > 1, mid).otherwise(F.col("hi")).cast("int")).withColumn("n", total)
        need = F.round(F.col("n") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")

        def take(acc, x):
            u = unit_hash(F.lit(seed), F.col("lo"), F.col("hi"), x["source"])
            return let(
                _draw(u, x["q"], acc["rest"], acc["need"]),
                lambda k: F.struct((acc["need"] - k).alias("need"), (acc["rest"] - x["q"]).alias("rest"), F.concat(acc["out"], F.array(k)).alias("out")),
            )

        zero = F.struct(need.alias("need"), F.col("n").alias("rest"), F.array().cast("array<bigint>").alias("out"))
        nodes = nodes.withColumn("left", F.when(F.col("mid") == F.col("hi"), F.transform("qs", lambda x: x["q"])).otherwise(F.aggregate("qs", zero, take)["out"]))
        halves = F.array(
            F.struct("lo", F.col("mid").alias("hi"), F.zip_with("qs", "left", lambda x, k: F.struct(x["source"].alias("source"), k.alias("q"))).alias("qs")),
            F.struct(F.col("mid").alias("lo"), "hi", F.zip_with("qs", "left", lambda x, k: F.struct(x["source"].alias("source"), (x["q"] - k).alias("q"))).alias("qs")),
        )
        nodes = nodes.select(F.explode(halves).alias("x")).select("x.*").where("lo < hi")
    cells = nodes.select("lo", F.explode("qs").alias("x")).select("lo", "x.*")  # one row for each source and shard
    upto = F.sum("q").over(Window.partitionBy("source").orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shards = cells.withColumn("upto", upto).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("lo", "upto"))).alias("cells"))
    return shards.select("source", F.transform("cells", lambda c: c["upto"]).alias("upto"))


def mix_plan(keys: DataFrame, num_shards: int = 8, seed: int = 20, block_words: int = 250_000, block_docs: int = 2_000, pool_words: int = 100_000, max_sources: int = 100_000, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Which shards take each row: ``keys`` (source, size long, h long) with ``shards array<int>`` and totals.

    ``keys`` is read several times: pass a stored table. ``h`` is the row's hash; rows with equal (source, h) count as one document repeated, and
    share one decision. Words taken from a source fall short of its target by less than the
    smallest document that was left out of the blocks around the rest's end (``pool_words``
    words and ``block_docs`` documents beyond it, about). Rows of size 0 come with
    every whole copy but never as part of the rest. An empty table gives an empty result.

    Windows of a source run over its blocks, one thin row for ``block_docs`` documents.
    """
    spark = keys.sparkSession
    keys = keys.select("source", "size", "h")
    stats = keys.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    goal = materialize(
        source_targets(stats, weights, share, cap)
        .withColumn("__base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("__rest", F.col("target") - F.col("__base") * F.col("source_size"))
        .withColumn("__blocks", F.greatest(F.least("docs", F.lit(4 * num_shards)), F.ceil(F.col("source_size") / block_words), F.ceil(F.col("docs") / block_docs)).cast("long")),
        "mix-goal",
    )
    if goal.count() > max_sources:
        raise ValueError(f"more than {max_sources} sources: weights are set for each source, so group them first")
    small = F.broadcast(goal.withColumnRenamed("source", "__s"))  # at most max_sources rows
    dealt = keys.join(small, keys.source.eqNullSafe(F.col("__s"))).drop("__s").withColumn("__block", F.pmod(F.xxhash64(F.lit(seed), "h"), F.col("__blocks")))

    by_block = ["source", "__block"]
    blocks = dealt.groupBy(*by_block).agg(F.sum("size").alias("words"), F.first("__base").alias("base"), F.first("__rest").alias("rest"), F.first("docs").alias("docs"), F.first("source_size").alias("source_size"))
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "source", "__block"), "__block")
    blocks = blocks.withColumn("upto", F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    blocks = blocks.withColumn("from", F.col("upto") - F.col("words")).withColumn("full", (F.col("upto") <= F.col("rest")) & (F.col("words") > 0))
    # What the rest lacks comes from the blocks around its end: in block and hash order, take each document that still fits.
    beyond = F.greatest(F.lit(0.0), F.col("from") - F.col("rest"))
    near = (beyond < pool_words) & (beyond * F.col("docs") <= F.col("source_size") * block_docs)
    blocks = materialize(blocks.withColumn("pool", ~F.col("full") & (F.col("words") > 0) & (F.col("rest") > 0) & near), "mix-blocks")
    taken = blocks.where("full").groupBy(F.col("source").alias("__t")).agg(F.sum("words").alias("__taken"))
    pool = blocks.where("pool").join(taken, F.col("source").eqNullSafe(F.col("__t")), "left")
    pool = pool.select(F.col("source").alias("__s"), F.col("__block").alias("__b"), F.col("from").alias("__from"), (F.col("rest") - F.coalesce("__taken", F.lit(0))).alias("__left"))
    edge = dealt.join(pool, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b"))).where("size > 0")
    edge = edge.groupBy("source", "h", "__block", "__from", "__left").agg(F.sum("size").alias("size"))
    edge = edge.groupBy("source").agg(F.first("__left").alias("__left"), F.array_sort(F.collect_list(F.struct("__from", F.xxhash64(F.lit(seed + 4), "h").alias("k"), "h", F.col("__block").alias("b"), "size"))).alias("xs"))
    picked = "array<struct<h:bigint,b:bigint>>"
    zero = F.struct(F.col("__left").cast("double").alias("left"), F.array().cast(picked).alias("hs"))

    def fit(acc, x):
        more = F.concat(acc["hs"], F.array(F.struct(x["h"].alias("h"), x["b"].alias("b"))).cast(picked))
        return F.when(x["size"] <= acc["left"], F.struct((acc["left"] - x["size"]).alias("left"), more.alias("hs"))).otherwise(acc)

    chosen = materialize(edge.select(F.col("source").alias("__s2"), F.explode(F.aggregate("xs", zero, fit)["hs"]).alias("x")).select("__s2", F.col("x.h").alias("__h"), F.col("x.b").alias("__b2")), "mix-chosen")

    copies = F.col("base") + F.when(F.col("full"), 1).otherwise(0)
    units = blocks.where(copies > 0).select(*by_block, F.explode(F.sequence(F.lit(1), copies)).alias("copy"), F.lit(False).alias("part"))
    units = units.union(chosen.select(F.col("__s2").alias("source"), F.col("__b2").alias("__block"), F.lit(0).alias("copy"), F.lit(True).alias("part")).distinct())
    quotas = units.groupBy("source").agg(F.count(F.lit(1)).alias("quota"))
    cuts = split_quotas(quotas, num_shards, seed + 2).withColumnRenamed("source", "__s")
    if goal.count() * (40 + 8 * num_shards) <= 64 << 20:  # else a shuffled join
        cuts = F.broadcast(cuts)
    place = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 3), "source", "__block", "copy"), "__block", "copy")
    placed = (
        units.withColumn("pos", F.row_number().over(place) - 1)
        .join(cuts, F.col("source").eqNullSafe(F.col("__s")))
        .withColumn("shard", F.size(F.filter("upto", lambda c: c <= F.col("pos"))))
        .groupBy(*by_block)
        .agg(
            F.array_sort(F.collect_list(F.when(~F.col("part"), F.col("shard")))).alias("__whole"),
            F.max(F.when(F.col("part"), F.col("shard"))).alias("__part"),
        )
    )
    chosen = chosen.select("__s2", "__h")
    placed = placed.select(F.col("source").alias("__s"), F.col("__block").alias("__b"), "__whole", "__part")
    out = dealt.join(placed, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")), "left")
    out = out.join(chosen, F.col("source").eqNullSafe(F.col("__s2")) & (F.col("h") == F.col("__h")), "left")
    shards = F.concat(F.coalesce("__whole", F.array().cast("array<int>")), F.when(F.col("__h").isNotNull() & F.col("__part").isNotNull(), F.array("__part")).otherwise(F.array().cast("array<int>")))
    return out.select("source", "size", "h", "source_size", "target", shards.alias("shards"))


def document_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def mix_counts(docs: DataFrame, num_shards: int = 8, seed: int = 20, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) for every row of ``docs``.

    Null texts have size 0. Null sources are one source, last in order. Reruns agree: all
    choices are hashes of ``seed`` and the rows.
    """
    keyed = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), document_hash(docs).alias("h")), "mix-docs")
    plan = mix_plan(keyed, num_shards, seed, **options)
    # Rows with equal (source, h) have one decision.
    plan = plan.dropDuplicates(["source", "h"]).select(F.col("source").alias("__s"), F.col("h").alias("__h"), "source_size", "target", "shards")
    joined = keyed.join(plan, (F.col("h") == F.col("__h")) & F.col("source").eqNullSafe(F.col("__s")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mixed_rows(docs: DataFrame, num_shards: int = 8, seed: int = 20, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each copy taken, shard by shard and shuffled inside.

    Null texts have size 0 and null sources are one source, last in order; rows repeated
    in ``docs`` have one decision. An empty table gives an empty result. A shard is
    written by several tasks, each with a run of hashes.
    """
    keyed = docs.withColumns({"__mix_size": word_count(F.col("text")), "__mix_h": document_hash(docs)})
    thin = materialize(keyed.select("source", F.col("__mix_size").alias("size"), F.col("__mix_h").alias("h")), "mix-docs")
    plan = mix_plan(thin, num_shards, seed, **options)
    plan = plan.where(F.size("shards") > 0).dropDuplicates(["source", "h"]).select(F.col("source").alias("__mix_s"), F.col("h").alias("__mix_k"), F.col("shards").alias("__mix_shards"))
    plan = materialize(plan, "mix-plan")
    if plan.count() * 120 <= 64 << 20:  # else a shuffled join
        plan = F.broadcast(plan)
    rows = keyed.join(plan, (F.col("__mix_h") == F.col("__mix_k")) & F.col("source").eqNullSafe(F.col("__mix_s")))
    rows = rows.select(*docs.columns, "__mix_h", F.posexplode("__mix_shards").alias("__mix_copy", "__mix_shard"))
    parts = max(num_shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = F.xxhash64(F.lit(seed + 5), "__mix_h", "__mix_copy")
    rows = rows.withColumn("__mix_run", F.floor(F.shiftrightunsigned(order, 32) * F.lit(-(-parts // num_shards)) / F.lit(2.0**32)))
    return rows.repartition(parts, "__mix_shard", "__mix_run").sortWithinPartitions("__mix_shard", "__mix_run", order).select(*docs.columns)
