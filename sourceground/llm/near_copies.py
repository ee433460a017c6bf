"""Near copies by the Jaccard similarity of word shingles: every pair at 0.8 or more is found, none below.

SimHash fingerprints of the shingle sets go through the vantage-point trees of ``simhash``
and give the first candidates. Sets at 0.8 differ in about ten of 64 bits, where balls
prune nothing, so fingerprints alone would lose such pairs; an exact bound (prefix
filter) completes them:

1. Shingles have one global order: those common in a share of the documents last, else by
   hash. Two sets at 0.8 share a shingle within the first fifth of either. The share
   moves only the order, never the result.
2. Equal sets are one node from the start. Nodes that share a shingle of their prefixes are
   candidates, if sizes, positions and sketches of both sets still leave room for 0.8.
   Of shingles that the same nodes hold, one stands for all.
3. Each node is first held against its fingerprint's neighbours and against a few heads of
   its shingles' nodes, in turns, and components of the true pairs are formed. All pairs
   between different components follow: a large group of near copies is one component by
   then, so its pairs are not listed.
4. Every candidate is decided by the exact similarity of its two whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, discard, materialize
from .simhash import hamming_links

SHINGLE = 5
SEED = 42
#: One in so many documents sets the order (of at least so many), and shingles that are set last at most.
#: A share, so that a passage which so many documents hold is seen as common at any size.
EVERY, SAMPLE = 12, 4096
COMMON = 200_000
#: Heads against which a node is held at a time, and at most so many turns with other heads, while
#: a turn finds true pairs in so large a share of what it tries. None decides what is found.
HEADS, TURNS, SHARE = 8, 3, 0.05
#: Shingles before a place that tell whether two sets have met already.
SEEN = 3
#: Bits in which fingerprints of the first candidates may differ.
RADIUS = 2


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; words and short texts as in ``simhash.fingerprint``, no words: none."""
    words = (text or "").encode().lower().split()
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    found = {digest(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)} if words else ()
    return np.sort(np.fromiter(found, np.uint64, len(found))).view(np.int64)


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with __text (hash of the text) and __row (hash of id, text and all other columns)."""
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    text = F.md5(F.coalesce("text", F.lit("")))
    row = F.md5(F.concat_ws("|", text, F.xxhash64(F.col("text").isNull(), *rest).cast("string"), F.col("doc_id").isNull().cast("string"), F.col("doc_id").cast("string")))
    return docs.withColumn("__text", text).withColumn("__row", row)


def first_row() -> Column:
    """The first row of a group of rows with ``row_keys``: smallest doc_id, null last, then by hashes."""
    return F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__text", "__row"))["__row"]


def keep_rows(keyed: DataFrame, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose __row is in ``kept``; rows equal in all columns collapse to one.

    ``rows`` holds the __row of every row. What is decided on these thin rows is what goes,
    broadcast while proven small; texts move only if it is not, and for rows that repeat.
    """
    counts = rows.groupBy("__row").agg(F.count(F.lit(1)).alias("n"))
    fate = counts.join(kept.select("__row", F.lit(True).alias("stays")), "__row", "left")
    fate = materialize(fate.where("stays is null or n > 1").select("__row", F.coalesce("stays", F.lit(False)).alias("stays")), "near-fate")
    out = keyed.join(_small(fate, 100), "__row", "left_anti")
    repeated = fate.where("stays")
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(_small(repeated, 100), "__row", "left_semi").dropDuplicates(["__row"]))
    return out.drop("__row", "__text")


def prefix_size(n: int) -> int:
    """A set that shares four fifths of ``n`` shingles shares one of so many, whichever they are."""
    return n - (4 * n + 4) // 5 + 1 if n else 0


def odd_sketch(own: np.ndarray, bits: int = 256) -> np.ndarray:
    """Longs of so many bits: bit h is set if an odd number of the shingles leave h as the remainder."""
    return np.packbits((np.bincount(own & (bits - 1), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def sketch(own: np.ndarray) -> int:
    """SimHash of a set: a bit is set if over half of the shingle hashes have it."""
    if not len(own):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(own), 65535):
        counts += np.unpackbits(own[at : at + 65535].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint16)
    return int(np.packbits(counts * 2 > len(own)).view(np.int64)[0])


def _common(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, documents) of shingles that at least two sampled documents hold."""
    every = max(1, min(EVERY, docs.count() // SAMPLE))

    def run(batches):
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py(), shingle))], names=["token"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0)
    counts = sample.select("text").mapInArrow(run, "token long").groupBy("token").count().where("count > 1")
    got = counts.orderBy(F.col("count").desc(), "token").limit(COMMON).toArrow()  # at most COMMON numbers
    tokens, n = got.column("token").to_numpy(), got.column("count").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _room(a: str, b: str) -> Column:
    """Can the sets ``a`` and ``b`` still be at 0.8, given their places of a shared shingle?

    ``pos`` shingles stand before it in the order, of which ``before`` occur in any other
    prefix: whoever holds this shingle in its prefix has no others of them. Sketches differ
    in at most as many bits as the sets differ in shingles: a ninth of both sizes at 0.8.
    """
    na, nb, at, bt, ax, bx = (F.col(f"{s}.{c}") for c in ("n", "pos", "before") for s in (a, b))
    shared = F.least(ax, bx) + 1 + F.least(na - at - 1, nb - bt - 1)
    differ = sum(F.bit_count(F.col(f"{a}.odd{i}").bitwiseXOR(F.col(f"{b}.odd{i}"))) for i in range(4))
    return (9 * differ <= na + nb) & (9 * shared >= 4 * (na + nb)) & (5 * F.least(na, nb) >= 4 * F.greatest(na, nb))


#: Bytes of one table that is sent: the driver holds it as rows, as a hash table and in blocks at a time, next to those of earlier joins.
SENT = 8 << 20


def _small(stored: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, broadcast while its rows are proven to stay under ``SENT`` bytes, so that the other side of a join does not move."""
    return F.broadcast(stored) if stored.count() * row_bytes <= SENT else stored


def distinct_sets(prints: DataFrame) -> DataFrame:
    """One row of ``prints`` for each set with shingles. Sets of several rows are a thin table, so rows stay where they are while it is proven small."""
    own = prints.where("n > 0")
    several = own.groupBy("sig").agg(F.min("__i").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("sig", "first")
    several = materialize(several, "near-several")
    one = own.join(_small(several, 40), "sig", "left").where("first is null or first = __i")
    return materialize(one.select("sig", "__row", "n", "prefix", "odd", "wide", "fp"), "near-nodes")


def _sets(keyed: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """(sig, hashes) of the stored ``rows`` (sig, __row); texts are read where they lie and do not move."""

    def run(batches):
        for batch in batches:
            sets = [shingles(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(sets, pa.list_(pa.int64()))], names=["sig", "hashes"])

    texts = keyed.select("__row", "text").join(_small(rows, 120), "__row").select("sig", "text")
    sets = materialize(texts.mapInArrow(run, "sig long, hashes array<long>"), "near-sets")
    if sets.count() > rows.count():  # rows equal in all columns
        sets = materialize(sets.dropDuplicates(["sig"]), "near-sets")
    return sets


def true_pairs(keyed: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, share: int = 1000) -> DataFrame:
    """Of the candidates ``pairs`` (node, hub), those whose whole sets are at 0.8 or more, as (a, b).

    The nodes' sets move once for each pair, to their hub. A hub of over ``share`` pairs is
    dealt over several groups, so no task holds all that link to one set.
    """
    low, high = F.least("node", "hub"), F.greatest("node", "hub")
    pairs = pairs.groupBy(low.alias("low"), high.alias("high")).agg(F.min("hub").alias("b"))
    pairs = materialize(pairs.select(F.when(F.col("b") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("a"), "b"), "near-candidates")
    # Sketches of 2,048 bits tell long sets apart before any set moves.
    ends = materialize(pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct(), "near-ends")
    wide = materialize(nodes.select("sig", "n", "wide", "__row").join(_small(ends, 40), "sig"), "near-wide")
    both = [wide.select(F.col("sig").alias(e), F.col("n").alias(f"n{e}"), F.col("wide").alias(f"w{e}")) for e in ("a", "b")]
    differ = F.aggregate(F.zip_with("wa", "wb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    left = materialize(pairs.join(both[0], "a").join(both[1], "b").where(9 * differ <= F.col("na") + F.col("nb")).select("a", "b"), "near-left")
    groups = left.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / share).alias("groups"))
    dealt = materialize(left.join(groups, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("groups")).alias("k")), "near-pairs")
    moved = materialize(wide.select("sig", "__row").join(dealt.select(F.explode(F.array("a", "b")).alias("sig")).distinct(), "sig"), "near-rows")
    sets = _sets(keyed, moved, shingle)
    hubs_ = materialize(dealt.select("b", "k").distinct(), "near-hubs")
    nodes_ = sets.select(F.col("sig").alias("a"), F.col("hashes").alias("x")).join(_small(dealt, 60), "a")
    hubs = sets.select(F.col("sig").alias("b"), F.col("hashes").alias("y")).join(_small(hubs_, 40), "b")
    alike = 9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))
    found = materialize(nodes_.join(hubs, ["b", "k"]).where(alike).select("a", "b"), "near-true")
    discard(sets, wide, pairs, ends, left, dealt, moved, hubs_)
    return found


def near_links(keyed: DataFrame, nodes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, root) of the components of all pairs at 0.8 or more, for sets that have such a pair; ``nodes`` has each set once."""
    thin = nodes.select("sig", F.posexplode("prefix").alias("pos", "token"))
    # Shingles that the same nodes hold name the same pairs: one of them stands for all (its holders by number, sum and exclusive or of hashes).
    hashed = F.xxhash64("sig")
    holders = [F.count("*").alias("nodes"), F.sum(F.shiftrightunsigned(hashed, 32)).alias("sum"), F.bit_xor(hashed).alias("xor")]
    met = materialize(thin.groupBy("token").agg(*holders).where("nodes > 1"), "near-met")
    stands = materialize(met.groupBy("nodes", "sum", "xor").agg(F.min("token").alias("token")).select("token", F.lit(True).alias("stands")), "near-stands")
    met = materialize(met.join(stands, "token", "left").select("token", "nodes", F.col("stands").isNotNull().alias("stands")), "near-met")
    own = Window.partitionBy("sig")
    before, common = F.row_number().over(own.orderBy("pos")) - 1, F.avg("nodes").over(own)
    places = thin.join(_small(met, 40), "token").select("token", "sig", "pos", "stands", before.alias("before"), common.alias("common")).where("stands")
    places = places.withColumn("prev", F.array_compact(F.array(*[F.lag("token", k).over(own.orderBy("pos")) for k in range(1, SEEN + 1)])))
    places = places.join(nodes.select("sig", "n", "odd"), "sig")
    places = places.select("token", "sig", F.struct("sig", "n", "pos", "before", "prev", *(F.col("odd")[i].alias(f"odd{i}") for i in range(4))).alias("x"), "common")
    places = materialize(places, "near-places")
    by = lambda c: F.struct(c, "x.sig")
    heads = places.groupBy("token").agg(F.max_by("x", by(F.col("common"))).alias("h1"), F.min_by("x", by(F.xxhash64("sig"))).alias("h2"))

    prints_ = materialize(nodes.groupBy("fp").agg(F.min("sig").alias("head")), "near-fingerprints")
    close = hamming_links(prints_.select("fp"), RADIUS)
    ends = [prints_.select(F.col("fp").alias(e), F.col("head").alias(to)) for e, to in (("a", "node"), ("b", "hub"))]
    close = close.join(ends[0], "a").join(ends[1], "b").select("node", "hub")
    alike = nodes.select("fp", "sig").join(prints_, "fp").where("sig <> head").select(F.col("sig").alias("node"), F.col("head").alias("hub"))

    star = places.join(heads, "token").select("x", F.explode(F.array("h1", "h2")).alias("h")).where((F.col("x.sig") != F.col("h.sig")) & _room("x", "h"))
    tried = materialize(_likely(star), "near-tried")
    found = true_pairs(keyed, nodes, tried.union(close).union(alike), shingle)
    labels = merged_labels(None, found)
    label = F.coalesce("root", "node").alias("label")
    turn, going = 0, True
    while True:
        # Thin rows tell which shingles still lie in several components; only their places go on.
        sent = _small(labels, 40)
        sizes = places.select("token", F.col("sig").alias("node")).join(sent, "node", "left").groupBy("token", label).count()
        most = sizes.groupBy("token").agg(F.max(F.struct("count", "label"))["label"].alias("most"), F.count("*").alias("labels")).where("labels > 1").select("token", "most")
        most = materialize(most, "near-most")
        held = places.select("token", "x", F.col("sig").alias("node")).join(_small(most, 40), "token").join(sent, "node", "left")
        held = materialize(held.select("token", "x", label, "most"), "near-held")
        if not going or turn == TURNS:
            break
        fresh = materialize(_again(held, tried, turn), "near-fresh")
        found = true_pairs(keyed, nodes, fresh, shingle)
        more = found.count()
        if not more:
            break
        labels, before_ = merged_labels(labels, found), labels
        tried, turn, going = tried.union(fresh), turn + 1, more >= SHARE * fresh.count()
        discard(held, most, before_, found)
    discard(places, met)
    few = held.where("label != most").select("token", F.col("x").alias("y"), F.col("label").alias("other"))
    # Two sets that share a shingle right before this one have met there.
    between = held.join(few, "token").where((F.col("label") != F.col("other")) & ~F.arrays_overlap("x.prev", "y.prev") & ((F.col("label") == F.col("most")) | (F.col("x.sig") < F.col("y.sig"))) & _room("x", "y"))
    rest = true_pairs(keyed, nodes, between.select(F.col("x.sig").alias("node"), F.col("y.sig").alias("hub")), shingle)
    discard(held)
    return merged_labels(labels, rest)


def merged_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after further links (a, b): components of the labels that they join, so what is known is not walked again."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = ends.select("node", F.col("node").alias("root"))
    if labels is not None:
        known = labels.union(known.join(labels.select("node"), "node", "left_anti"))
    known = materialize(known, "near-labels")
    of = lambda end: _small(known, 40).select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
    joined = links.join(of("a"), "a").join(of("b"), "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
    roots = connected_components(joined).select(F.col("node").alias("root"), F.col("root").alias("lower"))
    out = materialize(known.join(roots, "root", "left").select("node", F.coalesce("lower", "root").alias("root")), "near-labels")
    discard(known)
    return out


def _likely(star: DataFrame) -> DataFrame:
    """(node, hub): of each node's heads (x, h) the few that most of its shingles name."""
    votes = star.groupBy(F.col("x.sig").alias("node"), F.col("h.sig").alias("hub")).agg(F.count(F.lit(1)).alias("votes"))
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.col("votes").desc(), F.xxhash64("hub")))
    return votes.withColumn("__k", first).where(F.col("__k") <= HEADS).select("node", "hub")


def _again(held: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """(node, hub) not tried before: each place against two new heads of its shingle, one in the largest component and one beside it."""
    key = F.xxhash64(F.lit(turn), "token", "x.sig")
    largest = F.col("label") == F.col("most")
    pick = lambda when, what: F.min_by(what, F.when(when, key))
    whole = F.struct("x", "label")
    heads = held.groupBy("token").agg(pick(largest, whole).alias("h1"), pick(~largest, whole).alias("h2"))
    star = held.join(heads, "token").select("x", "label", F.explode(F.array("h1", "h2")).alias("y")).where(F.col("label") != F.col("y.label"))
    star = star.select("x", F.col("y.x").alias("h")).where(_room("x", "h"))
    return _likely(star).join(tried, ["node", "hub"], "left_anti")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without near copies: of each component of pairs at 0.8 or more, the row that is first by doc_id (null last) and text.

    Texts without words are one group. Rows are told apart by all their columns, so null or
    repeated ids lose nothing. Set hashes have 64 bits; whole sets are compared for pairs.
    """
    keyed = row_keys(docs)
    tokens, counts = _common(docs, shingle)

    def run(batches):
        for batch in batches:
            sig, size, odd, wide, fp, prefix = [], [], [], [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py(), shingle)
                sig.append(xxhash.xxh64_intdigest(own.tobytes(), SEED) - 2**63)
                size.append(len(own))
                odd.append(odd_sketch(own))
                wide.append(odd_sketch(own, 2048))
                fp.append(sketch(own))
                rank = np.zeros(len(own), np.int64)
                if len(tokens) and len(own):
                    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                    rank = np.where(tokens[at] == own, counts[at], 0)
                prefix.append(own[np.argsort(rank, kind="stable")[: prefix_size(len(own))]])
            names, longs = ["doc_id", "__text", "__row"], pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sig, pa.int64()), pa.array(size, pa.int64()), pa.array(odd, longs), pa.array(wide, longs), pa.array(fp, pa.int64()), pa.array(prefix, longs)], names=[*names, "sig", "n", "odd", "wide", "fp", "prefix"]
            )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    prints = keyed.select("doc_id", "__text", "__row", "text").mapInArrow(run, f"doc_id {doc_type}, __text string, __row string, sig long, n long, odd array<long>, wide array<long>, fp long, prefix array<long>")
    whole = materialize(prints.withColumn("__i", F.monotonically_increasing_id()), "near-prints")
    nodes = distinct_sets(whole)
    prints = materialize(whole.select("doc_id", "__text", "__row", "sig"), "near-ids")
    discard(whole)
    roots = near_links(keyed, nodes, shingle)
    discard(nodes)
    grouped = prints.join(roots, prints.sig == roots.node, "left").groupBy(F.coalesce("root", "sig")).agg(first_row().alias("__row"))
    return keep_rows(keyed, prints.select("__row"), grouped)
