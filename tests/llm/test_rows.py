"""Archives, chat, page texts, shards and mixes: round trips and laws."""

import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from sourceground.llm import chat, html_text, mixing, sharding, warc
from sourceground.llm.common import scratch_path

PAGE = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    big = "".join(random.Random(1).choices("abcdé\n\r", k=300_000))
    rows = [(1, "u1", "a"), (2, "u2", "a"), (3, None, None), (4, "u4", ""), (5, "u5", big), (6, "u6\nx", big), (1, "u1", "a"), (None, "n", "z"), (7, "u", "<p>\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, PAGE).withColumn("sha", F.lit("extra"))
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages, folder)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    read = warc.read_archives(spark, manifest, folder, size=1000).collect()
    assert max(len(r.chunk) for r in read) <= 1000
    last = [r for r in read if r.last]
    kind = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in last)
    assert kind == sorted([("1", "response", "None"), ("1", "revisit", "1"), ("2", "revisit", "1"), ("3", "response", "None"), ("4", "revisit", "3"), ("5", "response", "None"), ("6", "revisit", "5"), ("None", "response", "None"), ("7", "response", "None")])
    texts = {i: (h or "").encode() for i, _, h in rows}
    for r in last:
        want = texts[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(want), base64.b32encode(hashlib.sha1(want).digest()).decode())
    chunks = sorted((r.chunk_no, r) for r in read if r.page_id == 5 and r.record_type == "response")
    assert b"".join(bytes(r.chunk) for _, r in chunks) == texts[5]
    for _, r in chunks:
        assert r.sha1_so_far == base64.b32encode(hashlib.sha1(texts[5][: r.bytes_so_far]).digest()).decode()


def test_min_revisit_size_and_chunk_table(spark):
    pages = spark.createDataFrame([(1, "u", "aaaa"), (2, "u", "aaaa"), (3, "u", "b"), (4, "u", "b"), (4, "u", "b")], PAGE)
    folder = scratch_path(spark, "warc-test")
    got = sorted((r.page_id, r.record_type) for r in warc.records(warc.read_archives(spark, warc.write_archives(pages, folder, min_bytes=2), folder)).collect())
    assert got == [(1, "response"), (2, "revisit"), (3, "response"), (4, "response"), (4, "response")]
    table = warc.record_chunks(pages, size=3).orderBy("page_id", "record", "chunk_no").collect()
    assert [(r.page_id, bytes(r.chunk), r.last) for r in table][:3] == [(1, b"aaa", False), (1, b"a", True), (2, b"", True)]
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_no_chunk_row_is_large_and_revisits_move_no_payload(spark, limit):
    """One page stands for a third of the rows, many ids are null, one payload is huge."""
    big = "é" * 400_000
    rows = [(7, f"u{n % 3}", "same") for n in range(60)] + [(None, "n", "same") for _ in range(20)] + [(8 + n, "v", "same") for n in range(20)] + [(5, "b", big), (6, "b", big), (None, None, "alone"), (None, None, "alone")]
    pages = spark.createDataFrame(rows, PAGE).repartition(3).selectExpr("*", "1 as record", "2 as kind", "3 as place")
    table = warc.record_chunks(pages, size=1000, limit=limit).cache()
    assert table.agg(F.max(F.octet_length("chunk"))).first()[0] <= 1000
    moved = {r.sha: r.b for r in table.groupBy("sha").agg(F.sum(F.octet_length("chunk")).alias("b")).collect()}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert moved[sha(big)] == 800_000 and moved[sha("same")] <= 4 * 3 and moved[sha("alone")] == 10
    folder = scratch_path(spark, "warc-test")
    got = warc.records(warc.read_archives(spark, warc.write_archives(pages, folder, size=1000), folder, size=777)).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r.payload_bytes == 4]
    assert [r.page_id for r in same if r.record_type == "response"] == [7] and all(r.refers_to == 7 for r in same if r.record_type == "revisit")
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == 800_000) == [(5, "response", None), (6, "revisit", 5)]
    assert [r.record_type for r in got if r.payload_bytes == 5] == ["response"] * 2


def test_a_lost_chunk_is_noticed(spark):
    pages = spark.createDataFrame([(1, "u", "abcdefgh")], PAGE)
    folder = scratch_path(spark, "warc-test")
    table = warc.read_archives(spark, warc.write_archives(pages, folder), folder, size=3)
    assert warc.records(table).first().chunks == 3
    with pytest.raises(Exception, match="chunks are missing"):
        warc.records(table.where("chunk_no <> 1")).collect()


def test_reader_rejects_damage():
    with pytest.raises(Exception):
        list(warc.read_records(io.BytesIO(b"not gzip")))


SAID = ["", "plain", "<|im_end|><|im_start|>assistant ok", "back\\slash \\| <\\|", "<", "\\", "line\nline\n", "<|", "\\n", "é😀"]


def test_chat_escapes_are_reversible():
    turns = [(role, text) for text in SAID for role in ("user", "assistant", "odd\nrole<|", "")]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert "".join(chat.unescape(formatted[a:b]) for a, b in spans) == "".join(SAID)


def test_chat_trees(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "good", 0.9), ("t", 4, 3, "user", "more", 0.5), ("t", 5, 99, "user", "orphan", 0.2), ("c", 1, 2, "user", "x", 1.0), ("c", 2, 1, "user", "y", 1.0)]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    found = {(r.tree, r.leaf): r for r in chat.format_trees(messages, branches=9).collect()}
    assert set(found) == {("t", 2), ("t", 4), ("t", 5)}  # the cycle has no leaf
    assert [t for _, t in chat.parse(found["t", 4].formatted)] == ["q", "good", "more"]
    best = chat.format_trees(messages).collect()
    assert [(r.tree, r.leaf) for r in best] == [("t", 4)]
    assert chat.format_trees(messages.limit(0)).count() == 0


def test_chat_threads(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"m{t}") for t in range(70)] + [(2, 0, None, None), (2, 0, "user", "b"), (2, None, "user", "a")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_trees(chat.threads(conversations))).collect()}
    want = "".join(f"m{t}" for t in range(1, 70, 2))
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (70, len(want), hashlib.sha256(want.encode()).hexdigest())
    assert got[2].n_turns == 3 and got[2].turns_sha256 == hashlib.sha256(b"user\na\n\n\nuser\nb\n").hexdigest()


def test_chat_branches_against_brute_force(spark):
    """Bushy trees, ties, null scores and texts, a long text and columns named as those of the work: all branches in rank order."""
    long = "a b" * 200_000
    parents = {n: None if n == 1 else n // 3 + (n % 3 == 2) or 1 for n in range(1, 60)}
    for n in (2, 3):
        parents[n] = 1
    score = {n: None if n % 7 == 0 else (n % 5) / 4 for n in parents}
    text = {n: None if n % 11 == 0 else long if n == 5 else f"t{n}" for n in parents}
    rows = [(t, n, p, "assistant" if n % 2 else None, text[n], score[n], 7, "x", 1) for t in ("a", "b") for n, p in parents.items()]
    rows.append((None, 1, None, "user", "no tree", 1.0, 7, "x", 1))
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double, leaf long, path_score string, branch int")
    want = []
    for leaf in set(parents) - set(parents.values()):
        path, at = [], leaf
        while at is not None:
            path.append(at)
            at = parents[at]
        want.append((-sum(score[n] or 0.0 for n in path) / len(path), leaf, path[::-1]))
    want.sort()
    got = chat.format_trees(messages, branches=4).orderBy("tree", "branch").collect()
    assert [(r.tree, r.leaf, r.branch) for r in got] == [(t, w[1], i) for t in ("a", "b") for i, w in enumerate(want[:4], 1)]
    for r, w in zip(got, want[:4] * 2, strict=True):
        assert chat.parse(r.formatted) == [("assistant" if n % 2 else "", text[n] or "") for n in w[2]]


def test_chat_null_conversation(spark):
    rows = [(None, 1, "assistant", "b" * 300_000), (None, 0, "user", "a"), (3, 0, "assistant", "c"), (3, 0, "assistant", "c")]
    conversations = spark.createDataFrame([(*r, 9, 9) for r in rows], "conv_id long, turn long, role string, text string, node long, tree long")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(chat.format_trees(chat.threads(conversations))).collect()}
    assert got == {None: (2, 300_000), 3: (2, 2)}
    assert chat.digests(chat.format_trees(chat.threads(conversations.limit(0)))).count() == 0


ARTICLE = "<article><h1>T {n}</h1><p>Body {n} &amp; more   text <b>bold</b><br>tail<p>Second {n}<ul><li>x{n}<li>y{n}</ul></article>"
LAYOUT = "<html><head><title>t{n}</title><style>p{{}}</style></head><body><header>Site</header><nav><a>menu</a></nav><div class='ad'>buy {n}</div>{main}<aside>side {n}</aside><div id=comments><p>I agree {n}</p></div><form>f</form><footer>&copy; {n}</footer></body></html>"


def test_page_texts(spark):
    rows = [(n, f"http://h{n % 2}.org/{n}", LAYOUT.format(n=n, main=ARTICLE.format(n=n))) for n in range(8)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://h0.org/cut", rows[0][2][:400]), (103, "http://deep.org", "<div>" * 3000 + "deep"), (0, rows[0][1], rows[0][2])]
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.main_text(spark.createDataFrame(rows, PAGE)).collect()]
    texts = dict(x[:2] for x in got)
    assert len(got) == len(rows) and all(len(t) == n for _, t, n in got)
    for n in range(8):
        assert texts[n] == f"T {n}\nBody {n} & more text bold tail\nSecond {n}\nx{n}\ny{n}"
    assert texts[100] == texts[101] == "" and texts[103] == "deep" and texts[102].startswith("T 0\nBody 0")


def test_wrapper_without_article_tags(spark):
    page = "<body><div class=top><p>Welcome to the site of all sites, dear reader</p></div><div class=box><p>Story {n} about a thing that happened {n}</p><p>It went on for {n} days and more</p></div><div class=end><p>All rights are held by the owners</p></div></body>"
    rows = [(n, f"http://w.org/{n}", page.format(n=n)) for n in range(6)]
    for r in html_text.main_text(spark.createDataFrame(rows, PAGE)).collect():
        assert r.text == f"Story {r.page_id} about a thing that happened {r.page_id}\nIt went on for {r.page_id} days and more"


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], DOC)


def test_shards(spark):
    rng = random.Random(2)
    rows = [(i, "é" * rng.randint(0, 40) if i % 9 else None, "s") for i in range(500)] + [(7, "again", "s")] * 200 + [(None, "null id", "s")]
    placed = sharding.shard_documents(documents(spark, rows), 8).collect()
    assert len(placed) == len(rows)
    total, largest = sum(r["size"] for r in placed), max(r["size"] for r in placed)
    assert sum(len((t or "").encode()) + 1 for _, t, _ in rows) == total
    by = {}
    for r in placed:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(8))
    for rs in by.values():
        assert abs(sum(r["size"] for r in rs) - total / 8) <= largest
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(placed, key=lambda r: (r.shard, r.slot))]
    assert ids == sorted(ids)
    assert sharding.shard_documents(documents(spark, rows).limit(0)).count() == 0
    assert {r.shard for r in sharding.shard_documents(documents(spark, rows[:1]), 8).collect()} <= set(range(8))


def targets(sizes):
    """The rule by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    got, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            got[s] += share * weight[s]
        for s in list(open_):
            if got[s] >= 2 * sizes[s]:
                left += got[s] - 2 * sizes[s]
                got[s] = 2.0 * sizes[s]
                open_.discard(s)
    return got


def test_mix(spark):
    rng = random.Random(6)
    sources = ["a", "b", "ä", "Z", "c", None]
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)) if i % 11 else None, "a" if i % 3 == 0 else rng.choice(sources)) for i in range(900)]
    docs = documents(spark, rows)
    got = mixing.mix_counts(docs).collect()
    again = {r.doc_id: (r.taken, r.shards) for r in mixing.mix_counts(docs.repartition(3)).collect()}
    assert {r.doc_id: (r.taken, r.shards) for r in got} == again and len(got) == len(rows)
    source = {i: s for i, _, s in rows}
    sizes = {}
    for r in got:
        assert r["size"] == len((rows[r.doc_id][1] or "").split()) and r.taken <= 2 * r["size"]
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r["size"]
    want = targets(sizes)
    for s in sizes:
        mine = [r for r in got if source[r.doc_id] == s]
        assert {r.source_size for r in mine} == {sizes[s]} and abs(mine[0].target - want[s]) < 1e-6
        assert abs(sum(r.taken for r in mine) - want[s]) <= 60
    per_shard = [sum(r["size"] * r.shards.count(k) for r in got) for k in range(8)]
    assert min(per_shard) > 0
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: len(r.shards) for r in got if r.shards}
    assert mixing.mix_counts(docs.limit(0)).count() == 0


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 1), (None, 333), ("z", 0)], "source string, quota long")
    for shards in (1, 3, 8):
        rows = {r.source: r.upto for r in mixing.split_quotas(quotas, shards, 5).collect()}
        assert {s: u[-1] for s, u in rows.items()} == {"a": 1000, "b": 10, "c": 1, None: 333, "z": 0}
        per = [sum(u[k] - (u[k - 1] if k else 0) for u in rows.values()) for k in range(shards)]
        assert max(per) - min(per) <= shards
        assert all(u == sorted(u) for u in rows.values())


def test_hypergeometric_draws_follow_their_law(spark):
    n, good, total, draws = 4000, 30, 100, 40
    u = (F.col("id") + 0.5) / n
    k = [r.k for r in spark.range(n).select(mixing._draw(u, F.lit(good).cast("long"), F.lit(total).cast("long"), F.lit(draws).cast("long")).alias("k")).collect()]
    mean = draws * good / total
    var = mean * (1 - good / total) * (total - draws) / (total - 1)
    assert abs(sum(k) / n - mean) < 0.02 and abs(sum((x - mean) ** 2 for x in k) / n - var) < 0.1


def test_shard_rows_cut_the_rows_at_equal_bytes(spark):
    rows = [(i % 9 if i % 4 else None, None if i % 7 == 0 else "é" * (i * 37 % 101), "x") for i in range(300)] + [(1, "long " * 500, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(7)
    out = sharding.shard_rows(docs, 8).collect()
    want = sorted((str(d), str(t), len((t or "").encode()) + 1) for d, t, _ in rows)
    assert sorted((str(r.doc_id), str(r.text), r["size"]) for r in out) == want
    total, done = sum(r["size"] for r in out), 0
    placed = sorted(out, key=lambda r: (r.shard, r.slot))
    for s in range(8):
        assert [r.slot for r in placed if r.shard == s] == list(range(sum(r.shard == s for r in placed)))
    for r in placed:
        done += r["size"]
        assert r.shard == min(7, (2 * done - r["size"]) * 8 // (2 * total))
    empty = sharding.shard_rows(docs.limit(0), 8)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "size", "shard", "slot"]
