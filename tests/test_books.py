"""Book folders, segmentation against a plain loop, the corpus."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sourceground.operators import corpus as C
from sourceground.operators import passages as W
from sourceground.sources import books as S

BOOK = """====== 某書 ======
<book>
書名=某書
作者=張三
分類=傷寒 金匱
品質=90%
參本=
底本=宋本
分類=本草
別名=甲=乙
</book>
===== 卷一 =====
太陽之為病，脈浮，頭項強痛而惡寒。

<F>
**桂枝湯方**

桂枝<l>三兩，去皮</l>附子<l>一枚</l>
右二味，水煎服。
</F>
"""


def write(root, name, **files):
    (root / name).mkdir()
    for stem, text in files.items():
        (root / name / f"{stem}.txt").write_bytes(text if isinstance(text, bytes) else text.encode())


def test_files_order_and_metadata(spark, tmp_path):
    write(tmp_path, "甲 書", index=BOOK)
    write(tmp_path, "乙", index="<book>\n書名=\n</book>", **{"2": "二\n", "10": "十", "x": "no"})
    write(tmp_path, "丙", index=b"bad \xff byte", menu="<menu>\n3|c\n1|a\n9|gone\n1|again\n</menu>", **{"1": "一", "3": "三"})
    write(tmp_path, "丁", other="no index")
    files = S.read_book_files(spark, str(tmp_path))
    order = {}
    for r in S.file_order(files).orderBy("book_id", "file_ord").collect():
        order.setdefault(r.book_id, []).append(r.file_name)
    assert order == {"甲 書": ["index.txt"], "乙": ["2.txt", "10.txt"], "丙": ["3.txt", "1.txt", "1.txt"]}
    assert files.where("book_id = '丙' and file_name = 'index.txt'").first().content == "bad � byte"
    meta = {r.book_id: r for r in S.catalog(files).collect()}
    m = meta["甲 書"]
    assert (m.book_title_trad, m.category_level_1, m.base_text, m.quality_tier, m.extra) == ("某書", "本草類", "宋本", "test", {"別名": "甲=乙"})
    assert meta["乙"].book_title_trad == "" and meta["丙"].book_title_trad == "丙" and meta["丙"].author is None
    assert [r.line for r in S.book_lines(files).where("book_id = '乙'").orderBy("line_no").collect()] == ["二", "十"]


def test_corpus(spark, tmp_path):
    write(tmp_path, "甲", index=BOOK)
    rows = C.ingest(S.read_book_files(spark, str(tmp_path)), "2026-01-01").orderBy("passage_idx").collect()
    assert [r.chapter for r in rows] == ["某書", "某書"] and rows[1].section_title == "卷一"
    assert re.fullmatch(r"甲::0001::[0-9a-f]{12}", rows[1].passage_id)
    assert rows[1].formulas[0].formula_name == "桂枝湯" and rows[1].raw_text_trad.count("\n") == 3
    assert "T6" in rows[0].candidate_tasks and rows[0].source_url.endswith("book/甲/")


def plain(lines):
    """Passages by a loop over the lines: (path, joined lines)."""
    out, stack, held, inside = [], [], [], False

    def close():
        text = "\n".join(held).strip()
        if text:
            out.append(([t for _, t in stack], text))
        held.clear()

    for line in lines:
        s = line.strip()
        m = re.fullmatch(r"(={3,})\s*([^=]+?)\s*\1", s)
        if m and not inside:
            close()
            while stack and stack[-1][0] <= len(m[1]):
                stack.pop()
            stack.append((len(m[1]), m[2]))
        elif inside or "<F>" in s:
            held.append(line)
            inside = "</F>" not in s
        elif s:
            held.append(line)
        else:
            close()
    close()
    return out


@pytest.mark.parametrize(("part", "run"), [(2000, 250), (4, 2)])
def test_segmentation_matches_a_loop(spark, monkeypatch, part, run):
    """In whole books, and in parts so short that blocks, passages and headings run across them."""
    monkeypatch.setattr(W, "PART", part)
    monkeypatch.setattr(W, "NUMBERED", run)
    rng = random.Random(3)
    parts = ["", " ", "文一", "文二，", "<F>", "</F>", "<F>方</F>", "=== a ===", "==== b ====", "===== c =====", "文</F>尾", "=== d === <F>"]
    books = {f"b{i}": [rng.choice(parts) for _ in range(rng.randint(0, 25))] for i in range(150)}
    rows = [(b, n, line) for b, ls in books.items() for n, line in enumerate(ls, 1)]
    lines = spark.createDataFrame(rows, "book_id string, line_no long, line string")
    got = {}
    for r in W.passages(lines).select("book_id", "passage_idx", "heading_path", "raw_joined").orderBy("book_id", "passage_idx").collect():
        got.setdefault(r.book_id, []).append((r.heading_path, r.raw_joined))
    clean = lambda t: re.sub(r"</?F>", "", t).strip()  # noqa: E731  a passage of tags alone is none
    want = {b: kept for b, ls in books.items() if (kept := [x for x in plain(ls) if clean(x[1])])}
    assert got == want


def test_unclosed_block_is_reported(spark):
    rows = [("a", 1, "<F>"), ("a", 2, "x"), ("b", 1, "<F>y</F>")]
    found = W.unclosed_blocks(spark.createDataFrame(rows, "book_id string, line_no long, line string")).collect()
    assert [(r.book_id, r.line_no) for r in found] == [("a", 2)]


def test_deduplicate_and_trace(spark):
    rows = [("p1", "a", 0, "甲乙丙丁戊己庚辛壬癸"), ("p2", "a", 1, "子丑寅卯"), ("p3", "b", 0, "甲乙丙丁戊己庚辛壬癸")]
    corpus = spark.createDataFrame(rows, "passage_id string, book_id string, passage_idx int, normalized_text string")
    assert sorted(r.passage_id for r in C.deduplicate(corpus).collect()) == ["p1", "p2"]
    spans = spark.createDataFrame([(1, "丙，丁戊己庚辛壬癸"), (2, "丑寅"), (3, "無")], "span_id long, span string")
    assert sorted(tuple(r) for r in C.trace_spans(spans, corpus).collect()) == [(1, "p1"), (1, "p3"), (2, "p2")]
    assert C.trace_spans(spans.limit(0), corpus).count() == 0
    assert corpus.where(F.lit(False)).count() == 0


def test_no_heading_level_is_lost(spark):
    rows = [("a", n, "=" * (n + 2) + f" t{n} " + "=" * (n + 2)) for n in range(1, 31)] + [("a", 31, "=== low ==="), ("a", 32, "text")]
    lines = spark.createDataFrame(rows, "book_id string, line_no long, line string")
    assert W.heading_levels(lines) == list(range(32, 2, -1))
    assert [r.heading_path for r in W.passages(lines).collect()] == [["t30", "low"]]


def test_texts_are_not_dealt_by_book(spark, tmp_path):
    """Books, files and passages meet in thin tables that are sent to the texts; no task holds a book's passages."""
    write(tmp_path, "甲", index=BOOK)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = C.ingest(S.read_book_files(spark, str(tmp_path)), "2026-01-01")
        assert "hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
        assert made.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
