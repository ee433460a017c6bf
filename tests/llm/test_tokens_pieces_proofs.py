"""Merge-type tokens, fill-in-middle pieces and the Merkle manifest, each against a plain version."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sourceground.llm import fill_middle, merkle, sentencepieces

DOC = "doc_id long, source string, lang string, n_chars long, text string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_and_marks(rng, n):
    return "".join(rng.choices([" ", "  ", "▁", "a", "th", "\n", "\t", "é", "梦", "😀", "<s>", "<0x0A>", "<unk>", "́", "ing", "12", "!", "　", "\r\n"], k=n))


def test_agenda_gives_the_librarys_ids(spark):
    rng = random.Random(3)
    texts = [words_and_marks(rng, rng.randint(0, 60)) for _ in range(400)] + [None, "", " ", "x" * 5000, "ab" * 4000 + "梦" * 3000, "Same", "Same"]
    docs = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sentencepieces.encode(docs, sentencepieces.read_model(MODEL))
    assert got.columns == ["doc_id", "ids", "decoded", "agrees"]
    rows = got.collect()
    want = sorted((str(i if i % 50 else None), library.encode(t or "")) for i, t in enumerate(texts))
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == want
    assert all(r.agrees and r.decoded == library.decode(list(r.ids)) for r in rows)
    again = sentencepieces.decode(got.select("doc_id", "ids"), sentencepieces.read_model(MODEL)).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in rows)
    assert sentencepieces.encode(docs.limit(0), sentencepieces.read_model(MODEL)).count() == 0
    assert all(r.agrees is None for r in sentencepieces.encode(docs.limit(3), sentencepieces.read_model(MODEL), check=False).collect())


def test_remembered_words_are_bounded(monkeypatch):
    own = sentencepieces.Vocabulary(sentencepieces.read_model(MODEL))
    monkeypatch.setattr(sentencepieces, "STORE", 50)
    rng = random.Random(1)
    for _ in range(300):
        text = " ".join("".join(rng.choices("abcdefg", k=rng.randint(1, 9))) for _ in range(20)) + " " + "z" * 100
        assert own.encode(text) == own.library.encode(text)
        assert own.differing() == set() and own.fresh == []
        assert len(own.known) <= 50 and len(own.older) <= 50 and not any(len(w) > sentencepieces.LONGEST for w in own.known)


def test_words_that_differ_are_told():
    own = sentencepieces.Vocabulary(sentencepieces.read_model(MODEL))
    own.encode("one two")
    own.fresh.append(("▁three", (5, 6)))
    assert own.differing() == {"▁three"}


def naive_agenda(own, word):
    """Merge the best adjacent pair until none is a piece, looking at all pairs each time."""
    symbols = list(word)
    while True:
        pairs = [(-own.library.get_score(own.ids[a + b]), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in own.ids]
        if not pairs:
            return symbols
        at = min(pairs)[1]
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


def test_agenda_equals_looking_at_all_pairs():
    own = sentencepieces.Vocabulary(sentencepieces.read_model(MODEL))
    rng = random.Random(9)
    for _ in range(400):
        word = "▁" * rng.randint(0, 5) + "".join(rng.choices("aeinrst▁dhé", k=rng.randint(1, 40)))
        assert own.merged(word) == naive_agenda(own, word)


def plain_fill(doc_id, text):
    """The contract, by slices and regular expressions."""
    text, key = text or "", "" if doc_id is None else doc_id
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = [int(sha(f"7:{key}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100:
        return len(lines), "plain", None, None, sha(text), sha(text), text
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(lines), form, len(prefix), len(middle), sha(out), sha(text), out


def test_pieces_against_slices(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(["a", "é", "\n", "\r", " ", "😀", "<", "P>", "<S", ">", " "], k=rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "\n", "\n\n\n", "no end", "<M>", "é\n" * 300_000, "x" * 2_000_000, "twin\na\n", "twin\na\n"]
    rows = [(None if i % 97 == 5 else (i if i < len(texts) - 1 else i - 1), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pieces", F.lit("clash")).withColumn("__h1", F.lit("clash"))
    pieced = fill_middle.arrange(docs)
    got = fill_middle.digests(pieced).collect()
    key = lambda r: tuple(map(str, r))
    want = [(i, *plain_fill(i, t)) for i, t in rows]
    assert sorted(map(key, got)) == sorted(key(w[:-1]) for w in want)
    outputs = fill_middle.rendered(pieced)
    assert sorted((str(r.doc_id), r.form, r.output) for r in outputs.collect()) == sorted((str(w[0]), w[2], w[-1]) for w in want)
    assert sorted(r.text for r in fill_middle.restored(outputs).collect()) == sorted(t or "" for _, t in rows)
    assert fill_middle.digests(fill_middle.arrange(docs.limit(0))).count() == 0
    assert {r.form for r in fill_middle.arrange(docs, rate=0).select("form").distinct().collect()} == {"plain"}


def test_cutting_splits_descriptors():
    rng = random.Random(2)
    data = bytes(range(60))
    for _ in range(500):
        pieces = [(0, s, rng.randint(0, 9)) for s in rng.choices(range(50), k=rng.randint(0, 6))]
        whole = b"".join(data[s : s + n] for _, s, n in pieces)
        at = sorted(rng.choices(range(len(whole) + 1), k=rng.randint(0, 5)))
        ranges = [b"".join(data[s : s + n] for _, s, n in r) for r in fill_middle.cut(pieces, at)]
        assert ranges == [whole[a:b] for a, b in zip([0, *at], [*at, len(whole)], strict=True)]


def plain_manifest(rows, fan=8):
    """The whole trees in memory: (doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    low = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    leaf_of = lambda r, text: sha("".join(map(enc, (*r[:4], text))))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + fan])) for i in range(0, len(out[-1]), fan)])
        return out

    def path(tree, at):
        found = []
        for level in tree[:-1]:
            run = range(at - at % fan, min(at - at % fan + fan, len(level)))
            found.append(([level[k] for k in run if k < at], [level[k] for k in run if k > at]))
            at //= fan
        return found

    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    own = {v: sorted((r for r in rows if r[2] == v), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4]))) for v in langs}
    trees = {v: levels([leaf_of(r, r[4]) for r in own[v]]) for v in langs}
    top = levels([trees[v][-1][0] for v in langs]) if langs else []
    out = []
    for at, v in enumerate(langs):
        for k, r in enumerate(own[v]):
            proof = path(trees[v], k) + path(top, at)
            import zlib

            hit = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0
            node = leaf_of(r, low(r[4])) if hit else trees[v][0][k]
            for left, right in proof:
                node = sha("".join([*left, node, *right]))
            out.append((r[0], trees[v][0][k], trees[v][-1][0], top[-1][0], sha("".join(s for p in proof for side in p for s in side)), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize(("counts", "part"), [([700, 65, 64, 9, 8, 1, 1, 1, 1, 3], 50), ([513], 512), ([1], 7), ([0], 7), ([2, 1], 1), ([1] * 70, 4)])
def test_manifest_against_whole_trees(spark, counts, part):
    rng = random.Random(sum(counts))
    rows = []
    for k, n in enumerate(counts):
        lang = None if k == 3 else f"l{k}é" if k else "a hot one"
        for _ in range(n):
            i = len(rows)
            rows.append((None if i % 41 == 7 else i * 7 % 1000, None if i % 5 == 0 else f"s:{i % 3}", lang, None if i % 11 == 0 else i, rng.choice([None, "", "lower é", "Upper İ ÀZ", f"T{i}", "x" * 20_000])))
    if len(rows) > 100:
        rows += rows[20:60]  # repeated rows
    docs = spark.createDataFrame(rows, DOC).repartition(3).withColumn("leaf", F.lit("clash")).withColumn("tree", F.lit(0)).withColumn("idx", F.lit("clash"))
    got = merkle.manifest(docs, part).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(w) for w in plain_manifest(rows))


def test_multiproofs_are_minimal():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.choice([1, 2, 8, 9, 64, 65, 300])
        known = np.array(sorted(rng.sample(range(n), rng.randint(1, min(n, 20)))))
        want, level, own, size = set(), 0, set(known.tolist()), n
        while size > 1:  # siblings without a known leaf below them
            want |= {(level, k) for a in own for k in range(a - a % 8, min(a - a % 8 + 8, size)) if k not in own}
            own, size, level = {a // 8 for a in own}, -(-size // 8), level + 1
        assert {(lv, int(k)) for lv, ks in merkle.missing(known, n) for k in ks} == want
