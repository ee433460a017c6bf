"""Order keys, balanced and capped samples. Caps by ``row_number`` prune before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


def shuffle_key(seed: int, key: Column) -> Column:
    """A reproducible pseudo-random order: sort by this column."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), key), 256)


#: Letters of an order key that one histogram tells apart (hexadecimal: 4,096 bars), and rows of a border that are sorted.
LETTERS, BORDER = 3, 4096


def border(keys: DataFrame, order: list[str], n: int) -> Row | None:
    """The ``n``-th row of ``keys`` in the order of ``order``, whose first column is a hexadecimal hash; None if there are fewer.

    A histogram of the keys' first letters tells in which bar that row lies; the bar is told
    apart by further letters until few rows are left, and only these are sorted.
    """
    prefix, before = "", 0
    key = F.col(order[0])
    while True:
        at = len(prefix)
        inside = keys.where(key.startswith(prefix)) if prefix else keys
        bars = inside.groupBy(F.substring(key, 1, at + LETTERS).alias("bar")).agg(F.count(F.lit(1)).alias("rows")).orderBy("bar").collect()  # 16 ** LETTERS at most
        for bar, rows in bars:
            if before + rows >= n:
                break
            before += rows
        else:
            return None
        if rows <= BORDER or bar == prefix:  # equal keys have no further letters
            rest = inside.where(key.startswith(bar) if bar != prefix else key == bar)
            return rest.select(*order).orderBy(*order).limit(n - before).orderBy(*[F.col(c).desc() for c in order]).first()
        prefix = bar


def first_n(df: DataFrame, order: list[str], n: int, already: int = 0, keys: DataFrame | None = None) -> DataFrame:
    """The first rows up to a target, of which ``already`` are there.

    ``order`` names columns of ``df`` that no two rows share, the first a hexadecimal hash
    (``shuffle_key``). The rows are those up to ``border``: a filter, so nothing but order columns is
    sorted and no row moves. ``keys`` may hold the order columns alone, if that is cheaper to read.
    """
    wanted = max(0, n - already)
    if not wanted:
        return df.limit(0)
    last = border((keys if keys is not None else df).select(*order), order, wanted)
    return df if last is None else df.where(F.struct(*order) <= F.struct(*[F.lit(last[c]).alias(c) for c in order]))


#: Parts into which a bucket is dealt before its rows are ranked.
SALTS = 32


def bucket_depth(counts: list[int], n: int) -> int:
    """The most rows that one bucket gives when ``n`` are taken from all in turn."""
    low, high = 0, max(counts, default=0)
    while low < high:
        middle = (low + high) // 2
        if sum(min(c, middle) for c in counts) >= n:
            high = middle
        else:
            low = middle + 1
    return low


def balanced_take(items: DataFrame, n: int, order: list[str], buckets: tuple[str, ...] = ("task_code", "book_id")) -> DataFrame:
    """Up to ``n`` rows, one from each bucket in turn; buckets by first appearance, rows in input order (``order``).

    The buckets' counts tell how deep the turns go. Rows are ranked inside salted parts of
    their bucket and cut at that depth, then the survivors are ranked: a bucket that holds
    most rows is as many tasks as it has parts.
    """
    counts = [r["count"] for r in items.groupBy(*buckets).count().collect()]  # one number for each bucket
    depth = bucket_depth(counts, n)
    if not depth:
        return items.limit(0)
    dealt = items.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    part = F.row_number().over(Window.partitionBy(*buckets, "__salt").orderBy(*order))
    kept = dealt.withColumn("__rn", part).where(F.col("__rn") <= depth).drop("__salt", "__rn")
    by_bucket = Window.partitionBy(*buckets).orderBy(*order)
    first = F.first(F.struct(*order)).over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = kept.withColumns({"__rn": F.row_number().over(by_bucket), "__first": first}).where(F.col("__rn") <= depth)
    return ranked.orderBy("__rn", "__first").limit(n).drop("__rn", "__first")


def balanced_sample(corpus: DataFrame, per_book: int = 30) -> DataFrame:
    """Per book its first passages, those with formulas before the others."""
    order = Window.partitionBy("book_id").orderBy((F.size("formulas") == 0).cast("int"), "passage_idx")
    return corpus.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= per_book).drop("__rn")


def first_of_each(items: DataFrame, cap: int, order: list[str]) -> DataFrame:
    """The first ``cap`` items of each task and book."""
    w = Window.partitionBy("task_code", "book_id").orderBy(*order)
    return items.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= cap).drop("__rn")


def cap_items(items: DataFrame, cap: int, order: list[str]) -> DataFrame:
    """``first_of_each``, sorted by task, book and id."""
    return first_of_each(items, cap, order).orderBy("task_code", "book_id", "item_id")


def stratified_sample(corpus: DataFrame, stratum: str, k: int, seed: int) -> DataFrame:
    w = Window.partitionBy(stratum).orderBy(shuffle_key(seed, F.col("passage_id")), "passage_id")
    return corpus.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def top_reasons(checked: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent first errors of rejected items."""
    reasons = checked.where(F.size("errors") > 0).select(F.element_at("errors", 1).alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "reason").limit(k)


def release_corpus(corpus: DataFrame, sample: DataFrame, released: DataFrame, key: tuple[str, ...] = ("passage_id",)) -> DataFrame:
    """The sample and every further passage that a released item cites; ``key`` tells passages apart."""
    ids = sample.select(*key)
    cited = corpus.join(released.select(*key).distinct(), [*key], "left_semi").join(ids, [*key], "left_anti")
    return sample.unionByName(cited)
