"""Wrapper induction: tree matching against brute force, and pages whose names say nothing."""

import itertools
import random

import numpy as np
import pytest
from sourceground.llm import html_text as H

PAGE = "page_id long, url string, html string"


def best(x, y):
    """Most nodes that two trees with equal roots can share, by trying every order-keeping choice of children."""
    most = 0
    for n in range(min(len(x.kids), len(y.kids)) + 1):
        for a in itertools.combinations(x.kids, n):
            for b in itertools.combinations(y.kids, n):
                if all(p.key == q.key for p, q in zip(a, b, strict=True)):
                    most = max(most, sum(best(p, q) for p, q in zip(a, b, strict=True)))
    return 1 + most


def random_tree(rng, depth=3):
    tag = rng.choice(["div", "ul", "section"])
    inner = [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
    return f"<{tag}>{rng.choice('ab')}{''.join(inner)}</{tag}>"


def test_match_is_the_largest():
    rng = random.Random(4)
    matcher = H.Matcher()
    for _ in range(150):
        a, b = (matcher.number(H.bones_of(H.parse("<body>" + "".join(random_tree(rng, 2) for _ in range(3)))))[0] for _ in range(2))
        pairs = matcher.match(a, b)
        assert all(x.key == y.key for x, y in pairs) and len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert len(pairs) == best(a, b) == matcher.size(a.sig, b.sig)


def test_halved_tables_give_the_same_total():
    rng = np.random.default_rng(0)
    for n, m in ((1, 9), (30, 17), (9, 40)):
        w = rng.integers(0, 4, (n, m)).astype(float)
        whole, halved = (H.best_pairs(lambda i: w[i], n, m, cells) for cells in (1 << 24, 4))
        assert all(p < q and i < j for (p, i), (q, j) in itertools.pairwise(halved))
        assert sum(w[p] for p in whole) == sum(w[p] for p in halved)


def test_equal_texts_break_ties():
    matcher = H.Matcher()
    a = matcher.number(H.bones_of(H.parse("<div><p>1<p>2<p>Sign up</div>")))
    b = matcher.number(H.bones(H.skeleton(H.bones_of(H.parse("<div><p>x<p>y<p>z<p>w<p>Sign up</div>")))))
    assert (a[4].at, b[6].at) in [(x.at, y.at) for x, y in matcher.match(a[0], b[0])]


STORY = "<div class=q1><div class=q2>{n} {n} Cheap {n}</div><div class=q3><h2>Head {n}</h2><div class=q7>{ps}<p>Ask us for more letters</div></div><div class=q4><p>I think {n}</p><p>So do I {n}</p></div><div class=q5>Owned by {n} us</div></div>"


def stories(host, ns):
    return [(n, f"http://{host}/{n}", "<html><body><p>Welcome, dear reader, to the finest of all sites</p>" + STORY.format(n=n, ps="".join(f"<p>Part {k} of the story number {n} with words" for k in range(1 + n % 5))) + "</body></html>") for n in ns]


def test_content_and_template_come_from_alignment(spark, monkeypatch):
    """No article tag, no telling class; a constant line after a varying number of paragraphs is template; class names decide nothing."""
    rows = stories("w.org", range(12)) + [(99, "http://w.org/99", ""), (98, "http://w.org/98", None), (97, "http://w.org/97", "<p>404</p>")]
    pages = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 as host", "2 as skeleton", "3 as layout")

    def texts():
        return {r.page_id: r.text for r in H.main_text(pages).collect()}

    got = texts()
    for n in range(12):
        assert got[n] == "\n".join(f"Part {k} of the story number {n} with words" for k in range(1 + n % 5)), n
    assert got[98] == got[99] == ""
    monkeypatch.setattr(H, "NAMES", H.re.compile(r"q\d|."))
    assert {k: v for k, v in texts().items() if k < 90} == {k: v for k, v in got.items() if k < 90}


def test_template_inside_an_article_and_copies_of_a_page(spark):
    page = "<body><article><h1>Title {n}</h1><div class=x>Follow us now</div><p>Text {n} and more of it</p><p>The end of page</p></article></body>"
    rows = [(n, f"http://a.org/{n}", page.format(n=n)) for n in range(5)] + [(100 + n, "http://b.org/", page.format(n=7)) for n in range(20)]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert all(got[n] == f"Title {n}\nText {n} and more of it" for n in range(5))
    assert all(got[100 + n] == "Title 7\nFollow us now\nText 7 and more of it\nThe end of page" for n in range(20))  # copies are one page: no wrapper


def _say(n, words, of):
    return " ".join(f"{of}{n}x{k}" for k in range(words))


def _talk(n, of, items, words, inner="p", outer="div"):
    return f"<{outer} class={of}>" + "".join(f"<div class={of}1><{inner} class={of}2>{_say(n, 2, f'who{k}')}</{inner}><{inner}>{_say(n, words, f'reply{k}')}</{inner}></div>" for k in range(items)) + f"</{outer}>"


ARTICLE = "<article><h1>{h}</h1><p>{a}</p>{mid}<p>{b}</p>{end}</article>{out}"


@pytest.mark.parametrize("pages", [1, 2, 3, 12])
@pytest.mark.parametrize("case", ["named inside", "long named outside", "long outside", "long named articles", "short named outside", "wrapper named for its sidebar"])
def test_no_advert_and_no_comment_at_any_number_of_pages(spark, pages, case):
    rows, want = [], {}
    for n in range(pages):
        advert = f'<div class="advert">{_say(n, 12, "buy")}</div>'
        mid, end, out, wrap = advert, "", "", "{}"
        if case == "named inside":
            end = _talk(n, "comments", 1 + n % 3, 30)
        elif case == "long named outside":
            out = _talk(n, "comments", 2 + n % 2, 300)
        elif case == "long outside":
            out = _talk(n, "zz", 2 + n % 2, 150)
        elif case == "long named articles":
            out = f'<section id="comments">{"".join(f"<article class=comment><p>{_say(n, 90, f'r{k}')}</p></article>" for k in range(3))}</section>'
        elif case == "short named outside":
            out = advert + _talk(n, "reader-comments", 1, 5)
        else:
            wrap = '<div class="page has-sidebar comments-open">{}</div>'
            out = f'<div class="sidebar">{_say(n, 20, "side")}</div><div class="notice">{_say(n, 20, "note")}</div>'
        body = ARTICLE.format(h=_say(n, 2, "head"), a=_say(n, 40, "a"), b=_say(n, 40, "b"), mid=mid, end=end, out=out)
        rows.append((n, f"http://h{pages}.org/{n}", f"<html><body>{wrap.format(body)}</body></html>"))
        want[n] = "\n".join([_say(n, 2, "head"), _say(n, 40, "a"), _say(n, 40, "b")])
    assert {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, PAGE)).collect()} == want


def test_renamed_comments_inside_are_known_by_their_varying_number(spark):
    """Classes say nothing: the repeated items behind the text go, repeated parts with headings stay."""
    rows, want = [], {}
    for n in range(12):
        parts = "".join(f"<div class=k><h3>{_say(n, 2, f'sec{k}')}</h3><p>{_say(n, 15, f'in{k}')}</p></div>" for k in range(1 + n % 4))
        rows.append((n, f"http://r.org/{n}", "<html><body>" + ARTICLE.format(h=_say(n, 2, "head"), a=_say(n, 40, "a"), b=_say(n, 40, "b"), mid=parts, end=_talk(n, "zz", 2 + n % 5, 25), out="") + "</body></html>"))
        want[n] = "\n".join([_say(n, 2, "head"), _say(n, 40, "a"), *(_say(n, w, f"{of}{k}") for k in range(1 + n % 4) for of, w in (("sec", 2), ("in", 15))), _say(n, 40, "b")])
    assert {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, PAGE)).collect()} == want


def test_ties_between_children(spark):
    """Of two children with equally many words the first is the content."""
    tree = H.bones(H.skeleton(H.bones_of(H.parse("<div><div><p>a b c</div><div><p>d e f</div></div>"))))
    stats = {b.at: (3, 1, 9) for b in tree if b.words}
    assert H.induce(tree, stats)[0] == 2


def test_hosts_beyond_the_broadcast_limit(spark, monkeypatch):
    pages = spark.createDataFrame(stories("w.org", range(8)) + stories("v.org", range(20, 26)), PAGE)
    small = {r.page_id: r.text for r in H.main_text(pages).collect()}
    joined = H.joined_with
    monkeypatch.setattr(H, "joined_with", lambda *a: joined(*a, limit=0))
    assert {r.page_id: r.text for r in H.main_text(pages).collect()} == small


def test_deep_and_long_pages():
    matcher = H.Matcher()
    deep = H.parse("<div>" * 20_000 + "<b>" * 3000 + "deep" + "</i>" * 20_000)
    made = matcher.number(H.bones_of(deep))
    assert len(matcher.match(made[0], matcher.number(H.bones_of(H.parse("<div>" * 15_000)))[0])) == 15_001
    assert H.blocks(H.best_node(deep)) == ["deep"]
    long = matcher.number(H.bones_of(H.parse("<body>" + "".join(f"<p>{n}<h2>{n % 7}" for n in range(3000)))))
    short = matcher.number(H.bones_of(H.parse("<body>" + "".join(f"<h2>{n % 7}<p>{n}" for n in range(300)))))
    assert len(matcher.match(long[0], short[0])) == 602
