"""Nearest neighbours by multi-index hashing of learnt binary codes.

Codes are signs of learnt rotations (iterative quantisation, several rotations stacked),
fitted on a bounded sample. A code is cut into substrings and each is indexed. By the
pigeonhole principle a code within radius r of the query agrees with it up to r // m
bits in one of m substrings, so probing every substring index within that many bits
retrieves all codes within r. Survivors of the full Hamming test are ranked by cosine in
double precision. The radius is the distance within which nearly all true neighbours of
the sample lie; the substring length is the one that retrieved least of the sample.

Vectors are divided by their largest component, so parallel ones are equal from then on.
Equal vectors are one row with the smallest ids, which is all that a nearest list can hold
of them. These rows are shuffled once, into blocks; a task indexes a block when its rows
have passed and then answers the queries that follow in the same stream, so it holds one
block and one batch of queries. A query that finds too few rows in all blocks together
is ranked against every row in a second pass.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

#: Bits of a substring, by choice of what retrieves least.
WIDTHS = (16, 32, 64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn_rotations(sample: np.ndarray, tables: int = 4, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """A (dimension, tables * dimension') projection; each table is a rotation that iterative quantisation has adjusted."""
    d = sample.shape[1]
    width = -(-d // 16) * 16
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(tables):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0][:d]
        for _ in range(rounds if len(sample) >= d else 0):
            u, _, vt = np.linalg.svd(sample.T @ np.where(sample @ r > 0, 1.0, -1.0), full_matrices=False)
            r = u @ vt
        out.append(r)
    return np.hstack(out)


def encode(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as rows of 64-bit words."""
    return np.packbits(x @ rotations > 0, axis=1, bitorder="little").view("<u8")


def distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=-1, dtype=np.int64)


def learn_radius(sample: np.ndarray, codes: np.ndarray, k: int, quantile: float = 0.98, queries: int = 512) -> int:
    """The Hamming distance within which that share of the sample's true nearest neighbours lies."""
    n = min(queries, len(sample))
    if n < 2:
        return codes.shape[1] * 64
    near = sample[:n] @ sample.T
    near[np.arange(n), np.arange(n)] = -2
    top = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    return int(np.quantile(distance(codes[:n, None, :], codes[top]), quantile))


def learn_width(codes: np.ndarray, radius: int, queries: int = 128) -> int:
    """The substring length whose probes retrieve the smallest share of the sample."""
    share = {}
    for width in WIDTHS:
        index = MultiIndex(codes, width)
        share[width] = np.mean([index.probed(code, radius).mean() for code in codes[:queries]]) if len(codes) else 1.0
    return min(WIDTHS, key=lambda w: (share[w], w))


class MultiIndex:
    """Substring indexes over a block of codes."""

    def __init__(self, codes: np.ndarray, width: int = 16):
        self.codes, self.width, self.kind = codes, width, f"<u{width // 8}"
        parts = np.ascontiguousarray(codes).view(self.kind)
        self.orders, self.values, self.starts = [], [], []
        for j in range(parts.shape[1]):
            order = np.argsort(parts[:, j], kind="stable")
            values, starts = np.unique(parts[order, j], return_index=True)
            self.orders.append(order)
            self.values.append(values)
            self.starts.append(np.append(starts, len(order)))

    def probed(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Which rows agree with ``code`` closely enough in some substring."""
        parts = np.ascontiguousarray(code).view(self.kind)
        reach = radius // len(parts)
        seen = np.zeros(len(self.codes), bool)
        for j, part in enumerate(parts):
            values, starts = self.values[j], self.starts[j]
            if reach <= 1:  # few probes: look each one up
                flips = [0, *(1 << b for b in range(self.width))] if reach else [0]
                probes = np.array([int(part) ^ f for f in flips], values.dtype)
                at = np.searchsorted(values, probes)
                hit = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == probes)]
            else:  # more probes than keys: walk the keys
                hit = np.nonzero(np.bitwise_count(values ^ part) <= reach)[0]
            if len(hit) == len(values):
                return np.ones(len(self.codes), bool)
            if len(hit):
                spans = starts[hit + 1] - starts[hit]
                at = np.repeat(starts[hit] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
                seen[self.orders[j][at]] = True
        return seen

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        rows = np.nonzero(self.probed(code, radius))[0]
        return rows[distance(self.codes[rows], code) <= radius]


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def cosines(x: np.ndarray, squares: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with ``q``: each is summed by itself, so equal rows have equal scores wherever they stand."""
    return np.clip((x * q).sum(axis=1) / np.sqrt(squares * (q * q).sum()), -1.0, 1.0)


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not zero, and holds only finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0))


def scaled(vector: Column) -> Column:
    """The vector divided by its largest absolute component: the same for all parallel vectors of one direction."""
    return F.element_at(F.transform(F.array(F.array_max(F.transform(vector, F.abs))), lambda m: F.transform(vector, lambda x: x / m)), 1)


def first_ids(ids: list[list[int | None]], order: np.ndarray, k: int) -> list[tuple[int, int | None]]:
    """(position, id) of the first ``2 * k`` ids in ``order``, at most ``k`` for one id: k remain when any one id is left out."""
    out: list[tuple[int, int | None]] = []
    held: dict[int | None, int] = {}
    for at in order:
        for i in ids[at]:
            held[i] = held.get(i, 0) + 1
            if held[i] <= k or i is None:
                out.append((int(at), i))
                if len(out) == 2 * k:
                    return out
    return out


def best_rows(scores: np.ndarray, ids: list[list[int | None]], k: int) -> list[tuple[float, int | None]]:
    """(score, id) of the nearest rows, ties by id (null last), as many as ``first_ids`` needs."""
    need = 2 * k * k  # enough unless one id stands on many rows
    while True:
        kept = np.arange(len(scores))
        if need < len(scores):
            kept = np.nonzero(scores >= np.partition(scores, len(scores) - need)[len(scores) - need])[0]
        pairs = sorted((-float(scores[r]), i is None, i or 0) for r in kept for i in ids[r])
        order = [(-s, None if null else i) for s, null, i in pairs]
        out = [order[at] for at, _ in first_ids([[i] for _, i in order], np.arange(len(order)), k)]
        if len(out) == 2 * k or len(kept) == len(scores):
            return out
        need *= 8


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5, sample_rows: int = 4096, block_bytes: int = 64 << 20, least_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for each vec_id divisible by ``every``.

    ``vectors`` has (vec_id, embedding); other columns are not read. The sample (``sample_rows``
    smallest hashes of ids) fits rotations, radius and substrings only; every row is
    indexed. Vectors that are null, zero, or hold null or non-finite numbers take no part.
    Cosines exist between vectors of one length only, so each length is a search of its
    own. Rows that share a query's id
    are its own; of such rows one (the smallest vector) asks. Ties go to the smaller
    vec_id. Fewer rows than k: all of them. A null vec_id is a candidate, last among
    ties, and never a query. An empty table gives an empty result. A block holds at most
    ``block_bytes`` of vectors, and ``least_rows`` rows where that leaves tasks idle.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")), "v")
    rows = rows.select("vec_id", scaled(F.col("v")).alias("v"))
    lengths = [r.n for r in rows.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]  # one number for each length
    found = [_of_length(spark, rows.where(F.size("v") == d) if len(lengths) > 1 else rows, d, every, k, sample_rows, block_bytes, least_rows) for d in lengths or [1]]
    return functools.reduce(DataFrame.union, found)


def _of_length(spark: SparkSession, rows: DataFrame, d: int, every: int, k: int, sample_rows: int, block_bytes: int, least_rows: int) -> DataFrame:
    """``neighbours`` among scaled vectors (vec_id, v) of ``d`` numbers."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()  # bounded by the parameter
    sample = unit(np.array([r.v for r in picked], float).reshape(-1, d)) if picked else np.zeros((0, d))
    rotations = learn_rotations(sample)
    codes = encode(sample, rotations)
    radius = learn_radius(sample, codes, k)
    width = learn_width(codes, radius)

    key = [F.xxhash64("v"), F.xxhash64(F.lit(1), "v")]
    keyed = rows.select("vec_id", "v", key[0].alias("h1"), key[1].alias("h2"))
    by_id, by_vector = Window.partitionBy("h1", "h2", "vec_id"), Window.partitionBy("h1", "h2")
    few = keyed.withColumn("n", F.row_number().over(by_id.orderBy("h1"))).where((F.col("n") <= k) | F.col("vec_id").isNull())
    few = few.withColumn("n", F.row_number().over(by_vector.orderBy(F.col("vec_id").asc_nulls_last()))).where(F.col("n") <= 2 * k)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("n", "vec_id"))), lambda x: x["vec_id"])
    distinct = materialize(few.groupBy("h1", "h2").agg(F.first("v").alias("v"), ids.alias("ids")), "ann-rows")
    asked = keyed.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("v", "h1", "h2")).alias("x"))
    asked = materialize(asked.select("query_id", "x.v", "x.h1", "x.h2"), "ann-asked")
    queries = materialize(asked.groupBy("h1", "h2").agg(F.first("v").alias("v")), "ann-queries")

    total, parts = distinct.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-total * 8 * d // block_bytes), min(parts, total // least_rows))
    block = F.pmod(F.xxhash64(F.lit(2), "h1"), F.lit(blocks)).cast("int")
    found_schema = "h1 long, h2 long, score double, vec_id long"

    def search(queries: DataFrame, whole: bool) -> DataFrame:
        sides = distinct.select(block.alias("block"), F.lit(0).alias("asks"), "h1", "h2", "v", "ids").union(
            queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1), "h1", "h2", "v", F.array().cast("array<long>"))
        )

        def run(batches):
            at, held, index, x, squares, ids = None, [], None, None, None, []
            for batch in batches:
                place, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy()
                cuts = np.nonzero(np.diff(place * 2 + asks))[0] + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
                    piece = batch.slice(lo, hi - lo)
                    if place[lo] != at:
                        at, held, index, ids = place[lo], [], None, []
                    if not asks[lo]:
                        held.append(matrix(piece.column("v")))
                        ids += piece.column("ids").to_pylist()
                        continue
                    if not held:
                        continue
                    if index is None:
                        x = np.concatenate(held)
                        held = [x]
                        squares = (x * x).sum(axis=1)
                        index = MultiIndex(encode(unit(x), rotations), width)
                    asking = matrix(piece.column("v"))
                    keys = list(zip(piece.column("h1").to_pylist(), piece.column("h2").to_pylist(), strict=True))
                    out = []
                    for key, q, code in zip(keys, asking, encode(unit(asking), rotations), strict=True):
                        near = np.arange(len(x)) if whole else index.within(code, radius)
                        if len(near):
                            out += [(*key, *hit) for hit in best_rows(cosines(x[near], squares[near], q), _Picked(ids, near), k)]
                    columns = list(zip(*out, strict=True)) if out else [[]] * 4
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["h1", "h2", "score", "vec_id"])

        dealt = sides.repartition(min(2 * blocks, 10 * parts), "block").sortWithinPartitions("block", "asks")
        hits = dealt.mapInArrow(run, found_schema)
        one = Window.partitionBy("h1", "h2", "vec_id").orderBy(F.col("score").desc())
        best = Window.partitionBy("h1", "h2").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        hits = hits.withColumn("n", F.row_number().over(one)).where((F.col("n") <= k) | F.col("vec_id").isNull())
        hits = hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= 2 * k)
        return hits.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))  # at most 2 * k

    def answers(asked: DataFrame, found: DataFrame) -> DataFrame:
        """Each query's own list: the found rows without those of its id."""
        mine = asked.select("query_id", "h1", "h2").join(found, ["h1", "h2"], "left")
        others = F.filter("near", lambda x: ~x["vec_id"].eqNullSafe(F.col("query_id")))
        return mine.select("query_id", "h1", "h2", F.slice(F.coalesce(others, F.array().cast("array<struct<n:int,vec_id:bigint,score:double>>")), 1, k).alias("near"))

    first = materialize(answers(asked, search(queries, False)), "ann-found")
    short = first.where(F.size("near") < k).select("query_id", "h1", "h2")
    out = first.where(F.size("near") == k)
    if short.isEmpty():
        second = first.limit(0)
    else:
        short = materialize(short, "ann-short")
        second = answers(short, search(queries.join(short.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi"), True))
    return out.union(second).select("query_id", F.posexplode("near").alias("p", "x")).select("query_id", (F.col("p") + 1).alias("rank"), "x.vec_id", "x.score")


class _Picked:
    """The id lists of some rows, looked up when asked for."""

    def __init__(self, ids: list, rows: np.ndarray):
        self.ids, self.rows = ids, rows

    def __getitem__(self, at: int):
        return self.ids[self.rows[at]]
