"""Near copies, components, nearest neighbours and benchmark leaks against brute force."""

import math
import random

import numpy as np
import pytest
import xxhash

from sourceground.llm import ann, decontaminate, simhash
from sourceground.llm.common import connected_components

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    ids = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = ids[i], ids[j]
                ids = [min(a, b) if x in (a, b) else x for x in ids]
    return ids


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "A b", "É é A\x0bB c", "the cat sat on the mat " * 40, "x" * 200_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == brute_print(text)


def test_near_duplicates(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(15)]
    texts = [*base, *base[:4], base[0].upper(), None, "", "  "]
    for t in base[4:9]:
        w = t.split()
        w[7] = "changed"
        texts.append(" ".join(w))
    rng.shuffle(texts)
    docs = spark.createDataFrame([(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)], DOC)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_print(t) for t in texts]
    want = brute_components(prints, 2)
    assert {k: r.component_id for k, r in got.items()} == {100 + i: 100 + c for i, c in enumerate(want)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d", 7, 8, 9), (2, "A b c d", 7, 8, 9)], "doc_id long, text string, fp long, component_id long, member long")
    assert [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).orderBy("doc_id").collect()] == [(1, 1), (2, 1)]


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x", "y", 1), (1, "a b c d", "x", "y", 1), (None, "a b c d", "x", "y", 1), (None, "only null", "x", "y", 1)], DOC)
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(docs).collect()) == ["1", "1", "1", "None"]


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_vantage_trees_lose_no_pair(depth):
    rng = np.random.default_rng(depth)
    x = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    near = x[:400] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    cluster = x[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    fps = np.unique(np.concatenate([x, near, cluster]))
    tree = simhash.VantageTree(fps[::7], depth, 2)
    leaf, who, member = tree.route(fps)
    assert sorted(who[member].tolist()) == sorted(fps.tolist())
    links = []
    for at in range(2**depth):
        here = leaf == at
        links += list(zip(*(s.tolist() for s in simhash.leaf_links(who[here & member], who[here & ~member], 2, small=32)), strict=True))
    place = {v: i for i, v in enumerate(fps.tolist())}
    mine = simhash.forest(np.array([place[a] for a, _ in links], int), np.array([place[b] for _, b in links], int), len(fps))
    i, j = np.nonzero(simhash.hamming(fps[:, None], fps[None]) <= 2)
    assert (mine == simhash.forest(i, j, len(fps))).all()
    assert all(simhash.hamming(np.uint64(a), np.uint64(b)) <= 64 for a, b in links)


def same_components(links, fps):
    """Do the links give the components of all pairs within two bits?"""
    place = {v: i for i, v in enumerate(fps.view(np.int64).tolist())}
    mine = simhash.forest(np.array([place[a] for a, _ in links], int), np.array([place[b] for _, b in links], int), len(fps))
    i, j = np.nonzero(simhash.hamming(fps[:, None], fps[None]) <= 2)
    return (mine == simhash.forest(i, j, len(fps))).all()


@pytest.mark.parametrize(("copies", "sample"), [(1000, 16384), (4, 12), (1, 16384)])
def test_links_over_many_leaves(spark, monkeypatch, copies, sample):
    """Leaves of about 64 members: by the tree alone, or by groups of bits below a short tree or none. Components are those of brute force."""
    for name, value in (("LEAF_MEMBERS", 64), ("COPIES", copies), ("SAMPLE", sample)):
        monkeypatch.setattr(simhash, name, value)
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2**63, 1200, dtype=np.uint64)
    near = x[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    ball = x[5] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    close = x[9] ^ rng.integers(0, 2**10, 700, dtype=np.uint64)  # many in few bits: cut several times
    fps = np.unique(np.concatenate([x, near, ball, ball ^ np.uint64(3), close]))
    df = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp long")
    routed = simhash.route(df, 2)
    groups = routed.groupBy("leaf").count()
    assert groups.agg({"count": "max"}).first()[0] <= 4 * 64 * 2 and groups.count() > 8
    assert routed.where("member").select("fp").distinct().count() == len(fps)
    assert same_components([(r.a, r.b) for r in simhash.hamming_links(df).collect()], fps)


@pytest.mark.parametrize("mask", [0, 2**64 - 2**15, 0x5555_5555_5555_5555])
def test_partners_agree_in_one_part(mask):
    rng = np.random.default_rng(4)
    masks = list(simhash.parted(mask, 2))
    assert all(m & mask == mask and m != mask for m in masks)
    free = [b for b in range(64) if not mask >> b & 1]
    for _ in range(500):
        i, j = rng.choice(free, 2)
        assert any(not m >> int(i) & 1 and not m >> int(j) & 1 for m in masks)


def test_copies_do_not_grow_with_leaves(spark, monkeypatch):
    """Rows for each random fingerprint: under COPIES from the tree, and three times that where its leaves are cut once."""
    monkeypatch.setattr(simhash, "LEAF_MEMBERS", 16)
    rng = np.random.default_rng(2)
    for leaves in (2**5, 2**9):
        fps = np.unique(rng.integers(-(2**63), 2**63, 16 * leaves))
        n = simhash.route(spark.createDataFrame([(int(v),) for v in fps], "fp long"), 2).count()
        assert n <= 3 * simhash.COPIES * len(fps)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 100), (7, 7), (500, 500), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 90: 90, 100: 90, 500: 500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def exact(vectors, every, k):
    ids = [i for i, _ in vectors]
    x = np.array([v for _, v in vectors], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for n, q in enumerate(ids):
        if q % every == 0:
            s = x @ x[n]
            out[q] = sorted((-s[m], i) for m, i in enumerate(ids) if i != q)[:k]
    return out


def test_neighbours_recall_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=64).tolist()) for i in range(1500)]
    bad = [(2000, None), (2050, [0.0] * 64), (2100, [float("nan")] * 64), (2150, [1.0, None] * 32), (2200, [1.0] * 3), (2250, [float("inf")] + [0.0] * 63)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>")
    got = ann.neighbours(df, least_rows=400).collect()
    want = exact([(i, np.float32(v).astype(float)) for i, v in good], 50, 5)
    assert {r.query_id for r in got} == set(want) and len(got) == 5 * len(want)
    hits = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in got)
    assert hits >= 0.9 * len(got)
    for r in got:
        x, y = (np.float32(good[i][1]).astype(float) for i in (r.query_id, r.vec_id))
        assert abs(r.score - x @ y / np.sqrt(x @ x) / np.sqrt(y @ y)) < 1e-12
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all(v == sorted(v) for v in by.values())


def test_neighbours_few_and_ties(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r.vec_id, r.score) for r in ann.neighbours(df).orderBy("rank").collect()] == [(1, 2, 1.0), (2, 3, 1.0)]
    assert ann.neighbours(df.limit(0)).count() == 0


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2**63, (3000, 1), dtype=np.uint64)
    codes[1::2] = codes[::2] ^ (np.uint64(1) << rng.integers(0, 64, (1500, 1)).astype(np.uint64))
    for width in ann.WIDTHS:
        index = ann.MultiIndex(codes, width)
        for radius in (0, 1, 3, 5, 12, 40):
            for q in range(0, 60, 7):
                want = np.nonzero(np.bitwise_count(codes ^ codes[q]).sum(axis=1) <= radius)[0]
                assert (np.sort(index.within(codes[q], radius)) == want).all()


@pytest.mark.parametrize("n", [6, 7, 11, 40])
@pytest.mark.parametrize("least", [4096, 3])
def test_ties_go_to_the_smaller_ids(spark, n, least):
    """Equal and parallel vectors around a query, in one block and over several; repeated, null and own ids; extra columns."""
    rng = np.random.default_rng(n)
    base = rng.integers(-9, 9, 16).astype(float)
    rows = [(50, base.tolist())] + [(101 + i, (base * (1, 3, 0.5)[i % 3]).tolist()) for i in range(n)]
    rows += [(100, (-base).tolist()), (150, base.tolist()), (150, base.tolist()), (None, base.tolist())] + [(1000 + i, rng.normal(size=16).tolist()) for i in range(30) if i % 50]
    rng.shuffle(order := list(range(len(rows))))
    df = spark.createDataFrame([rows[i] for i in order], "vec_id long, embedding array<double>").selectExpr("*", "1 as h1", "2 as v", "3 as block")
    got = {}
    for r in ann.neighbours(df, least_rows=least).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    near = [i for i, _ in got[50]]
    assert near == [101, 102, 103, 104, 105] and {s for _, s in got[50]} == {1.0}
    assert [i for i, _ in got[150]] == [50, 101, 102, 103, 104]
    assert len(got[100]) == 5 and set(got) == {50, 100, 150}


def test_one_id_on_many_rows(spark):
    rows = [(50, [1.0, i / 1000]) for i in range(60)] + [(i, [1.0, 0.5 + i / 100]) for i in range(1, 8)]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5]


def test_probing_prunes_clustered_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 64))
    x = centres[rng.integers(0, 60, 3000)] + 0.05 * rng.normal(size=(3000, 64))
    sample = ann.unit(x)
    codes = ann.encode(sample, ann.learn_rotations(sample))
    radius = ann.learn_radius(sample, codes, 5)
    index = ann.MultiIndex(codes, ann.learn_width(codes, radius))
    share = np.mean([index.probed(codes[q], radius).mean() for q in range(0, 3000, 50)])
    assert share < 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {(r.query_id, r.vec_id) for r in ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), least_rows=500).collect()}
    want = {(q, i) for q, near in exact(rows, 50, 5).items() for _, i in near}
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)


def brute_hits(docs, items):
    """BM25 by its definition over all items, every window against every item."""
    kept = {(i, t): decontaminate.words_of(t) for i, t in items if decontaminate.words_of(t)}
    n, mean = len(kept), sum(map(len, kept.values())) / max(1, len(kept))
    df = {}
    for words in kept.values():
        for w in set(words):
            df[w] = df.get(w, 0) + 1

    def bm25(query, words):
        return sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * words.count(w) * 2.2 / (words.count(w) + 1.2 * (0.25 + 0.75 * len(words) / mean)) for w in sorted(query & set(words)))

    step, out = max(map(len, kept.values()), default=1), {}
    for d, text in docs:
        passage = decontaminate.words_of(text)
        for k in range(0, len(passage), step):
            window = passage[k : k + 2 * step]
            for (i, t), words in kept.items():
                score = bm25(set(window), words)
                if score >= 0.8 * bm25(set(words), words) - 1e-9 and all(decontaminate.overlap(p, window) >= 0.8 for p in decontaminate.question_and_answer(t)):
                    out[d, i] = max(score, out.get((d, i), 0.0))
    return out


def test_decontamination(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)] + ["the", "of"] * 20
    item = lambda n: " ".join(rng.choices(words, k=n - 4)) + ". " + " ".join(rng.choices(words, k=4)) + "."
    items = [(i, item(rng.randint(12, 30))) for i in range(25)] + [(98, None), (99, ""), (3, "short")]
    docs = []
    for d in range(60):
        body = rng.choices(words, k=rng.randint(0, 150))
        if d % 3 == 0:
            at = rng.randint(0, len(body))
            body[at:at] = items[d % 25][1].upper().split()
        if d % 7 == 0:
            body = body[: len(body) // 2]
        docs.append((d, " ".join(body)))
    docs += [(1000, None), (1001, "")]
    docs += [(2000, " ".join([*rng.choices(words, k=3000), *items[5][1].split(), *rng.choices(words, k=3000)])), (0, docs[0][1]), (None, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as item_id")
    bench = spark.createDataFrame(items + items[:3], "item_id long, text string").selectExpr("*", "1 as bm25")
    want = brute_hits(docs, items)
    for groups in ({}, {"group_rows": 10}):
        got = decontaminate.contaminated(df, bench, **groups).collect()
        assert {(r.doc_id, r.item_id) for r in got} == set(want) and len(want) > 10
        assert all(abs(r.bm25 - want[r.doc_id, r.item_id]) < 1e-9 for r in got)
        assert len(got) == len(want) + sum(d == 0 for d, _ in want)  # a repeated row gives its rows again
    clean = {r.doc_id for r in decontaminate.keep_clean(df, bench).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.keep_clean(df, bench.limit(0)).count() == df.count()
    assert decontaminate.keep_clean(df, bench, group_rows=10).count() == decontaminate.keep_clean(df, bench).count()


def test_long_texts_in_pieces_give_the_same_hits():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(40)]
    text = " ".join(" ".join([*rng.choices(words, k=rng.randint(0, 90)), items[n % 40][1]]) for n in range(60))
    whole = decontaminate.Index(items)
    seen = lambda hits: sorted((h.item_id, round(h.score, 9)) for h in hits)
    want = seen(whole.search([text]))
    assert len(want) == 40
    for most in (1, 2, 7):
        assert seen(whole.search([None, text], most)) == want


def test_wand_is_exact():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    index = decontaminate.Index([(i, " ".join(rng.choices(words, k=rng.randint(3, 25)))) for i in range(300)])
    for _ in range(60):
        terms = sorted(index.vocabulary[w] for w in set(rng.choices(words, k=rng.randint(1, 40))) if w in index.vocabulary)
        scores = np.zeros(300)
        for t in terms:
            scores[index.item[index.at[t] : index.at[t + 1]]] += index.impact[index.at[t] : index.at[t + 1]]
        for threshold in (0.5, 0.9, 1.0):
            want = np.nonzero(scores >= threshold)[0].tolist()
            assert [i for i, _ in index.wand(terms, threshold)] == want


def test_each_vector_length_is_a_search_of_its_own(spark):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3 if i % 4 == 1 else 8)]) for i in range(203)]
    rows = [(50 * (i // 4) if i % 40 == 1 else 1000 + i, v) for i, v in rows]  # queries of both lengths
    got = {}
    for r in ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q, v in rows:
        if q % 50 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)) / (sum(a * a for a in v) * sum(b * b for b in w)) ** 0.5, i) for i, w in rows if i != q and len(w) == len(v))
            assert len(set(got[q]) & {i for _, i in near[:3]}) >= 2, q
