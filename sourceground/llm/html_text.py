"""Main text of web pages by wrapper induction.

Pages of one host that use the same structural tags share a layout. Each page is reduced
to a skeleton: its block elements, and for each a hash and the word count of its own text.
A layout's exemplar is aligned with every distinct page of the layout by simple tree
matching (structure decides, equal texts break ties). Sums over these alignments tell
template from content: a node whose text is the same on nearly all pages is template, the
others are slots, and the content node is where the words of the slots are. Each page is
aligned once more and read from that node, without the template nodes below it.

Tags that are never running text (menus, footers, forms, scripts and the like) are left out
everywhere, and so are nodes that a class, id or role names an advert, a notice, a menu or
reader comments, at any number of pages. Comments without such a name are known by the
alignment: repeated siblings of one shape, without headings, whose number varies over the
pages and that follow the text. Vaguer names decide only where nothing can be induced.
"""

from __future__ import annotations

import html as html_lib
import json
import re
import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Never running text, wherever they stand.
DROPPED = frozenset("nav footer aside form button select option input textarea script style noscript template iframe svg math head title dialog menu object canvas audio video".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
#: Class names and ids of adverts, notices, menus and of reader comments; they count unless the node holds the page's heading.
ASIDES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?|sidebars?|menus?|navbar|navigation|breadcrumbs?|footer|site-?header|masthead|cookies?|consent|notices?|notifications?|newsletter)(?:$|[\s_-])", re.I
)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|comment-?(?:list|section|thread|area|body)s?|user-?comments?|reader-?comments?|disqus(?:_thread)?|repl(?:y|ies)|respond|discussion)(?:$|[\s_-])", re.I)
#: Class names and ids of what may be no article; only for pages without a wrapper.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|sidebars?|side|menus?|nav|navbar|navigation|breadcrumbs?|footer|site-?header|masthead|"
    r"cookies?|consent|notices?|notifications?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|comments?|disqus|replies|respond|share|sharing|social|related|recommended|widget|pagination|pager|skip|hidden)(?:$|[\s_-])",
    re.I,
)
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table div article section main body".split())
#: Elements that hold an article or parts of a page, as lists, headings and paragraphs do not.
HOLDERS = frozenset("#root html body div section article main center table tbody tr td".split())
REPLY_TAGS = frozenset("div li article section dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[/!?a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
DIGITS = re.compile(r"\d+")

#: Distinct pages from which a wrapper is induced; share of them that makes a text constant; share of the words that leads to a child.
LEAST, CONSTANT, MOST = 3, 0.9, 0.5
#: Exemplars have at most so many nodes where a layout has such pages.
EXEMPLAR_NODES = 2000


class Node:
    __slots__ = ("drop", "key", "kids", "named", "parent", "tag")

    def __init__(self, tag: str, key: str, drop: bool, named: bool, parent: "Node | None"):
        self.tag, self.key, self.drop, self.named, self.parent, self.kids = tag, key, drop, named, parent, []


def parse(html: str | None) -> Node:
    """A tree of a page; text pieces are strings among ``kids``. Bad markup never fails."""
    root = node = Node("#root", "#root", False, False, None)
    asides: list[tuple[Node, bool]] = []
    html = html or ""
    at, end = 0, len(html)
    opened: dict[str, int] = {}

    def leave(to: Node) -> Node:
        n = node
        while n is not to:
            opened[n.tag] -= 1
            n = n.parent
        return to

    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            node.kids.append(html[at:])
            break
        if m.start() > at:
            node.kids.append(html[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if not opened.get(tag):
                continue
            up = node
            while up.tag != tag:
                if tag in ("p", "li", "td", "th", "tr") and up.tag in SCOPES:
                    up = None
                    break
                up = up.parent
            if up is not None:
                node = leave(up.parent)
            continue
        if tag in CLOSES_P:
            up = node
            while up is not root and up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                node = leave(up.parent)
        elif tag in CLOSES:
            up = node
            while up is not root and up.tag not in SCOPES and up.tag not in CLOSES[tag]:
                up = up.parent
            if up.tag in CLOSES[tag]:
                node = leave(up.parent)
                if tag == "tr" and node.tag == "tr":
                    node = leave(node.parent)
        attributes = m.group(3)
        drop, named, key, aside, said = tag in DROPPED, False, tag, False, False
        if attributes and not attributes.isspace():
            for name, *values in ATTRIBUTE.findall(attributes):
                value, name = next((v for v in values if v), ""), name.lower()
                if name in ("class", "id"):
                    key += f".{DIGITS.sub('#', value)}"
                    named = named or bool(NAMES.search(value))
                    aside, said = aside or bool(ASIDES.search(value)), said or bool(COMMENTS.search(value))
                elif name == "role":
                    drop = drop or value.lower() in DROPPED_ROLES
                else:
                    drop = drop or value.lower() != "false"
        if tag in ("html", "body", "article", "main", "h1"):
            drop = named = False
        if tag == "header" and not (opened.get("article") or opened.get("main")):
            drop = True  # of the page; in an article it opens the text
        new = Node(tag, key, drop, named, node)
        node.kids.append(new)
        if (aside or said) and not drop and tag not in ("html", "body", "main", "h1"):
            asides.append((new, said))
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else end
        elif tag not in VOID and not attributes.endswith("/"):
            node = new
            opened[tag] = opened.get(tag, 0) + 1
    for n, said in asides:
        n.drop = not holds(n, ("h1", "main") if said else ("h1", "main", "article"))
    return root


def holds(node: Node, tags: tuple[str, ...]) -> bool:
    """Is one of ``tags`` below the node? Then its name tells of the page, as in ``has-sidebar``, not of itself."""
    stack = [k for k in node.kids if k.__class__ is Node]
    while stack:
        n = stack.pop()
        if n.tag in tags:
            return True
        stack += [k for k in n.kids if k.__class__ is Node]
    return False


def elements(node: Node) -> list[Node]:
    return [k for k in node.kids if k.__class__ is Node and k.tag not in INLINE and k.tag not in RAW]


def words_in(node: Node, by_name: bool = True) -> int:
    """Words of a subtree that are neither dropped nor inside links; ``by_name`` also leaves out what class names drop."""
    total, stack = 0, [node]
    while stack:
        n = stack.pop()
        if n.__class__ is str:
            total += len(n.split())
        elif not (n.drop or n.tag == "a" or (by_name and n.named)):
            stack += n.kids
    return total


def own_text(node: Node) -> tuple[str, int]:
    """Text of a node and its inline children in normal white space, and its words outside links."""
    parts: list[str] = []
    words, stack = 0, [(k, False) for k in reversed(node.kids)]
    while stack:
        k, linked = stack.pop()
        if k.__class__ is str:
            parts.append(k)
            words += 0 if linked else len(k.split())
        elif k.tag in INLINE:
            stack += [(x, linked or k.tag == "a") for x in reversed(k.kids)]
    return " ".join(" ".join(parts).split()), words


class Bone:
    """A skeleton node: ``sig`` names the structure of its subtree, ``said`` hashes all texts in it."""

    __slots__ = ("at", "drop", "key", "kids", "node", "said", "sig", "tag", "text", "words")

    def __init__(self, at: int, tag: str, key: str, drop: bool, text: int, words: int, node: Node | None = None):
        self.at, self.tag, self.key, self.drop, self.text, self.words, self.node, self.kids = at, tag, key, drop, text, words, node, []


def bones_of(root: Node) -> list[Bone]:
    """The block elements of a page in page order."""
    made: list[Bone] = []
    stack: list[tuple[Node, Bone | None]] = [(root, None)]
    while stack:
        node, above = stack.pop()
        text, words = own_text(node)
        bone = Bone(len(made), node.tag, node.key, node.drop, zlib.crc32(text.encode()) if text else 0, words, node)
        made.append(bone)
        if above is not None:
            above.kids.append(bone)
        stack += [(k, bone) for k in reversed(elements(node))]
    return made


def skeleton(made: list[Bone]) -> str:
    """[depth, tag, key, drop, hash of own text, words] of each bone, as JSON."""
    depth = {made[0].at: 0}
    for b in made:
        depth |= dict.fromkeys((k.at for k in b.kids), depth[b.at] + 1)
    return json.dumps([[depth[b.at], b.tag, b.key, int(b.drop), b.text, b.words] for b in made], ensure_ascii=False, separators=(",", ":"))


def bones(text: str) -> list[Bone]:
    """The bones that ``skeleton`` wrote."""
    made: list[Bone] = []
    path: list[Bone] = []
    for at, (depth, tag, key, drop, crc, words) in enumerate(json.loads(text)):
        bone = Bone(at, tag, key, bool(drop), crc, words)
        made.append(bone)
        del path[depth:]
        if path:
            path[-1].kids.append(bone)
        path.append(bone)
    return made


def best_pairs(weights, n: int, m: int, cells: int = 1 << 24) -> list[tuple[int, int]]:
    """The order-keeping pairs (i, j) of largest total weight; ``weights(i)`` is row i over all m columns, 0 where a pair may not be.

    A row of the table is one running maximum. Tables beyond ``cells`` are halved at the
    row's best split, so memory stays bounded and the result exact.
    """
    if not n or not m:
        return []

    def last_row(rows, flip: bool, lo: int, hi: int) -> np.ndarray:
        best = np.zeros(hi - lo + 1)
        for i in rows:
            w = weights(i)[lo:hi]
            grown = best.copy()
            np.maximum(grown[1:], best[:-1] + (w[::-1] if flip else w), out=grown[1:])
            best = np.maximum.accumulate(grown)
        return best

    found: list[tuple[int, int]] = []
    stack = [(0, n, 0, m)]
    while stack:
        top, end, lo, hi = stack.pop()
        if top == end or lo == hi:
            continue
        if (end - top) * (hi - lo) > cells and end - top > 1:
            mid = (top + end) // 2
            above, below = last_row(range(top, mid), False, lo, hi), last_row(range(end - 1, mid - 1, -1), True, lo, hi)
            cut = lo + int(np.argmax(above + below[::-1]))
            stack += [(top, mid, lo, cut), (mid, end, cut, hi)]
            continue
        best = np.zeros(hi - lo + 1)
        up, taken = [], []
        for i in range(top, end):
            w = weights(i)[lo:hi]
            diagonal = np.where(w > 0, best[:-1] + w, -1.0)
            grown = best.copy()
            np.maximum(grown[1:], diagonal, out=grown[1:])
            now = np.maximum.accumulate(grown)
            up.append(np.packbits(now == best))
            taken.append(np.packbits(np.append(False, now[1:] == diagonal)))
            best = now
        i, j = end - top, hi - lo
        bit = lambda row, at: row[at >> 3] >> (7 - (at & 7)) & 1
        while i and j:
            if bit(up[i - 1], j):
                i -= 1
            elif bit(taken[i - 1], j):
                i, j = i - 1, j - 1
                found.append((top + i, lo + j))
            else:
                j -= 1
    return sorted(found)


class Matcher:
    """Simple tree matching, with the structures of subtrees numbered so that equal ones are compared once."""

    def __init__(self, most: int = 200_000):
        self.most, self.numbers, self.shapes, self.sizes = most, {}, [], {}

    def number(self, made: list[Bone]) -> list[Bone]:
        """Sets ``sig`` and ``said`` of each bone."""
        for b in reversed(made):
            shape = (b.key, *(k.sig for k in b.kids))
            if (sig := self.numbers.get(shape)) is None:
                sig = self.numbers[shape] = len(self.shapes)
                self.shapes.append(shape)
            b.sig, b.said = sig, hash((b.text, *(k.said for k in b.kids))) if b.kids else b.text
        return made

    def full(self) -> bool:
        """Has the memory bound been reached? Then a new matcher must number all trees anew."""
        return len(self.shapes) + len(self.sizes) > self.most

    def _common(self, x: int, y: int) -> int | None:
        """Nodes that two structures with equal keys can share; None if pairs of children are still to be sized."""
        xs, ys = self.shapes[x][1:], self.shapes[y][1:]
        if x == y:
            return self._nodes(x)
        waiting = [(p, q) for p in set(xs) for q in set(ys) if self.shapes[p][0] == self.shapes[q][0] and (p, q) not in self.sizes]
        if waiting:
            self.stack += waiting
            return None
        return 1 + int(sum(self._row(p, ys)[j] for p, j in ((xs[i], j) for i, j in best_pairs(self._rows(xs, ys), len(xs), len(ys)))))

    def _nodes(self, sig: int) -> int:
        total, stack = 0, [sig]
        while stack:
            total += 1
            stack += self.shapes[stack.pop()][1:]
        return total

    def _row(self, p: int, ys) -> np.ndarray:
        key = self.shapes[p][0]
        return np.array([self.sizes[p, q] if self.shapes[q][0] == key else 0 for q in ys], float)

    def _rows(self, xs, ys):
        rows: dict[int, np.ndarray] = {}

        def row(i: int) -> np.ndarray:
            p = xs[i]
            if p not in rows:
                rows[p] = self._row(p, ys)
            return rows[p]

        return row

    def size(self, x: int, y: int) -> int:
        """Nodes of the largest match of two structures whose keys are equal."""
        self.stack = [(x, y)]
        while self.stack:
            pair = self.stack[-1]
            if pair not in self.sizes:
                got = self._common(*pair)
                if got is None:
                    continue
                self.sizes[pair] = got
            self.stack.pop()
        return self.sizes[x, y]

    def match(self, a: Bone, b: Bone) -> list[tuple[Bone, Bone]]:
        """Pairs of the largest order-keeping match of nodes with equal keys whose parents match; of equal ones that with most equal texts."""
        found, stack = [], [(a, b)]
        while stack:
            x, y = stack.pop()
            found.append((x, y))
            if not x.kids or not y.kids:
                continue
            if x.sig == y.sig and x.said == y.said:
                stack += zip(x.kids, y.kids, strict=True)
                continue
            xk, yk = [k.key for k in x.kids], [k.key for k in y.kids]
            if xk == yk and len(set(xk)) == len(xk):
                stack += zip(x.kids, y.kids, strict=True)
                continue
            flat = not any(k.kids for k in x.kids) or not any(k.kids for k in y.kids)
            if flat and not {k.said for k in x.kids if k.said} & {k.said for k in y.kids if k.said}:
                # Every pair weighs the same: equal ends belong together.
                n, head, tail = min(len(xk), len(yk)), 0, 0
                while head < n and xk[head] == yk[head]:
                    head += 1
                while tail < n - head and xk[-1 - tail] == yk[-1 - tail]:
                    tail += 1
                if head + tail == n:
                    stack += [*zip(x.kids[:head], y.kids[:head], strict=True), *(zip(x.kids[-tail:], y.kids[-tail:], strict=True) if tail else ())]
                    continue
            xs, ys = [k.sig for k in x.kids], [k.sig for k in y.kids]
            for p in set(xs):
                for q in set(ys):
                    if self.shapes[p][0] == self.shapes[q][0] and (p, q) not in self.sizes:
                        self.size(p, q)
            rows, said = self._rows(xs, ys), np.array([k.said for k in y.kids])
            scale = 1.0 + min(len(xs), len(ys))  # all equal texts together weigh less than one node

            def weights(i: int, rows=rows, said=said, kids=x.kids, scale=scale) -> np.ndarray:
                row = rows(i)
                return np.where(row > 0, scale * row + (said == kids[i].said), 0.0)

            stack += [(x.kids[i], y.kids[j]) for i, j in best_pairs(weights, len(xs), len(ys))]
        return found


def blocks(node: Node, template: frozenset[int] = frozenset(), by_name: bool = False, left: frozenset[int] = frozenset()) -> list[str]:
    """Texts of the blocks below ``node`` in page order, without dropped nodes, those in ``left`` and the own texts of those in ``template``."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            if text:
                out.append(text)
            held.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif x.__class__ is str:
            held.append(x)
        elif x.tag == "br":
            held.append(" ")
        elif not (x.drop or id(x) in left or (by_name and x.named)):
            if x.tag in INLINE:
                stack += reversed(x.kids)
            else:
                flush()
                stack.append(None)
                stack += reversed(elements(x) if id(x) in template else x.kids)
    flush()
    return out


def best_node(root: Node) -> Node:
    """Where a page that no wrapper explains holds its text: an article or main element, else the deepest node with most words."""
    named: list[tuple[int, Node]] = []
    stack = [root]
    while stack:
        n = stack.pop()
        if n.drop or n.named:
            continue
        if n.tag in ("article", "main"):
            named.append((words_in(n), n))
        stack += reversed(elements(n))
    if named:
        pool = [x for x in named if x[1].tag == "article"] or named
        return max(pool, key=lambda x: x[0])[1]
    node, total = root, words_in(root)
    while True:
        inner = [(words_in(k), k) for k in elements(node) if not k.drop and not k.named]
        top = max(inner, key=lambda x: x[0], default=(0, node))
        if top[0] < 0.8 * total or not elements(top[1]):
            return node
        node = top[1]


def below(bone: Bone) -> list[Bone]:
    """The bone and all below it."""
    out, stack = [], [bone]
    while stack:
        out.append(stack.pop())
        stack += out[-1].kids
    return out


def reply_runs(tree: list[Bone], stats: dict[int, tuple[int, ...]], fixed: set[int]) -> list[tuple[Bone, str]]:
    """(parent, key) of runs of children that are reader comments: two or more of one shape with parts of their own and no
    headings, fewer of them on some pages than on others, behind text that is at least a quarter of theirs."""
    words = lambda bs: sum(stats.get(b.at, (0, 0, 0))[2] for b in bs if b.at not in fixed and not b.drop)
    pages = max((s[0] for s in stats.values()), default=0)
    found: list[tuple[Bone, str]] = []
    for parent in tree:
        keys = [k.key for k in parent.kids if k.tag in REPLY_TAGS and not k.drop]
        for key in {k for k in keys if keys.count(k) > 1}:
            items = [below(k) for k in parent.kids if k.key == key and not k.drop]
            if any(len(i[0].kids) < 2 or any(b.tag in HEADINGS for b in i) for i in items):
                continue
            seen = [max((stats[b.at][0] for b in i if b.at in stats), default=0) for i in items]
            before = words(b for b in tree if b.at < items[0][0].at)
            if min(seen) < pages and before and 4 * before >= sum(map(words, items)):
                found.append((parent, key))
    return found


def induce(tree: list[Bone], stats: dict[int, tuple[int, ...]]) -> tuple[int, list[int], list[tuple[int, str]]]:
    """(index of the content node, indexes of constant nodes, reader comments as (index of their parent, key)), from (pages,
    pages with the commonest text, words) of each node.

    A node is constant if at least ``LEAST`` pages have text in it, and ``CONSTANT`` of them
    the same. From the root down, the content is in the child with most words of slots,
    while that is a holder with ``MOST`` of them; a holder without parts must have nearly
    all. An article or main element with a tenth of the slots' words is where the way
    begins; one that has paragraphs beside that child is taken whole. Dropped nodes and
    comments have no words.
    """
    constant = [b.at for b in tree if (s := stats.get(b.at)) and s[0] >= LEAST and s[1] >= CONSTANT * s[0]]
    fixed = set(constant)
    replies = reply_runs(tree, stats, fixed)
    lost = {k.at for parent, key in replies for k in parent.kids if k.key == key}
    total: dict[int, int] = {}
    for b in reversed(tree):
        own = 0 if b.at in fixed else stats.get(b.at, (0, 0, 0))[2]
        total[b.at] = 0 if b.drop or b.at in lost else own + sum(total[k.at] for k in b.kids)
    hidden = {b.at for n in tree if n.drop or n.at in lost for b in below(n)} if any(b.drop for b in tree) or lost else set()
    named = [b for b in tree if b.tag in ("article", "main") and b.at not in hidden and 10 * total[b.at] >= total[tree[0].at] > 0]
    node = max(named, key=lambda b: total[b.at]) if named else tree[0]
    while node.kids:
        top = max(node.kids, key=lambda k: total[k.at])
        share = total[top.at] / max(1, total[node.at])
        if not total[top.at] or top.tag not in HOLDERS or share < (MOST if top.kids else 0.8):
            break
        if node.tag in ("article", "main") and any(k.tag in PARAGRAPHS and total[k.at] for k in node.kids):
            break
        node = top
    return node.at, constant, [(parent.at, key) for parent, key in replies]


def host_of(url: Column) -> Column:
    """Lower-case host of an address; empty for null and for what is no address."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def layout_of(html: Column) -> Column:
    """A hash of the structural tags that a page uses."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"<(article|main|header|section|table|nav|aside|footer|form)[\s>]"), F.lit(1))
    return F.xxhash64(F.array_sort(F.array_distinct(tags)))


def joined_with(pages: DataFrame, small: DataFrame, keys: list[str], row_bytes: int, limit: int = 64 << 20, salts: int = 16) -> DataFrame:
    """``pages`` left-joined with a stored table: broadcast while its rows, at ``row_bytes`` each, are proven to stay under ``limit``.

    Beyond, both sides are shuffled; pages of one key go to ``salts`` tasks, so a host with
    a third of all pages is not one task.
    """
    if small.count() * row_bytes <= limit:
        return pages.join(F.broadcast(small), keys, "left")
    spread = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = pages.withColumn("__salt", F.pmod(F.xxhash64("page_id", "html" if "html" in pages.columns else "skeleton"), F.lit(salts)).cast("int"))
    return dealt.join(spread, [*keys, "__salt"], "left").drop("__salt")


class _Trees:
    """Numbered skeletons by text, for the layouts that a task met last."""

    def __init__(self, most: int = 500):
        self.held, self.most, self.matcher = OrderedDict(), most, Matcher()

    def get(self, text: str) -> list[Bone]:
        if self.matcher.full():
            self.held.clear()
            self.matcher = Matcher()
        tree = self.held.get(text)
        if tree is None:
            tree = self.held[text] = self.matcher.number(bones(text))
            if len(self.held) > self.most:
                self.held.popitem(last=False)
        return tree


def host_templates(keyed: DataFrame) -> DataFrame:
    """(host, layout, skeleton, content, constant array<long>, replies array<string>) for each layout of ``keyed`` (page_id, host, layout, html) that has a wrapper.

    A layout with fewer than ``LEAST`` distinct pages uses the exemplar of its host's
    commonest layout, if the host has that many pages at all.
    """

    def reduce_(batches):
        for batch in batches:
            made = [bones_of(parse(h)) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("layout"), pa.array([len(m) for m in made], pa.int32()), pa.array([skeleton(m) for m in made], pa.string())],
                names=["page_id", "host", "layout", "nodes", "skeleton"],
            )

    page_type = keyed.schema["page_id"].dataType.simpleString()
    some = keyed.where(F.length(F.coalesce("html", F.lit(""))) > 0).select("page_id", "host", "layout", "html")
    drawn = some.mapInArrow(reduce_, f"page_id {page_type}, host string, layout long, nodes int, skeleton string")
    drawn = materialize(drawn.withColumn("sig", F.xxhash64("skeleton")), "skeletons")
    pages = materialize(drawn.groupBy("host", "layout", "sig").agg(F.min("page_id").alias("page_id"), F.first("nodes").alias("nodes"), F.first("skeleton").alias("skeleton")), "skeletons-distinct")

    first = F.min_by("skeleton", F.struct(F.col("nodes") > EXEMPLAR_NODES, F.xxhash64("sig"), "sig"))
    layouts = materialize(pages.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"), first.alias("skeleton")), "layouts")
    hosts = layouts.groupBy("host").agg(F.sum("n").alias("all"), F.max_by("layout", F.struct("n", "layout")).alias("usual"))
    own = layouts.join(hosts, "host").where(F.col("all") >= LEAST).withColumn("group", F.when(F.col("n") >= LEAST, F.col("layout")).otherwise(F.col("usual")))
    exemplars = own.select("host", F.col("layout").alias("group"), F.col("skeleton").alias("exemplar"))
    groups = materialize(own.select("host", "layout", "group").join(exemplars, ["host", "group"]), "layout-groups")
    width = groups.agg(F.max(F.octet_length("exemplar") + F.octet_length("host"))).first()[0] or 0
    joined = joined_with(pages.select("page_id", "host", "layout", "skeleton"), groups, ["host", "layout"], 80 + width).where("exemplar is not null")

    def observe(batches):
        trees = _Trees()
        for batch in batches:
            sums: dict[tuple[str, int, int, int], list[int]] = {}
            for host, group, page, text in zip(*(batch.column(c).to_pylist() for c in ("host", "group", "skeleton", "exemplar")), strict=True):
                tree = trees.get(text)
                for node, bone in trees.matcher.match(trees.matcher.number(bones(page))[0], tree[0]):
                    if node.words or node.text:
                        got = sums.setdefault((host, group, bone.at, node.text), [0, 0])
                        got[0] += 1
                        got[1] += node.words
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in sums], pa.string()), *(pa.array([k[i] for k in sums], pa.int64()) for i in (1, 2, 3)), *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(2))],
                    names=["host", "group", "node", "text", "pages", "words"],
                )

    seen = joined.select("host", "group", "skeleton", "exemplar").mapInArrow(observe, "host string, group long, node long, text long, pages long, words long")
    texts = seen.groupBy("host", "group", "node", "text").agg(F.sum("pages").alias("pages"), F.sum("words").alias("words"))
    sums = texts.groupBy("host", "group", "node").agg(F.sum("pages").alias("pages"), F.max("pages").alias("same"), F.sum("words").alias("words"), F.max_by("text", F.struct("pages", "text")).alias("text"))
    nodes = sums.groupBy("host", "group").agg(F.collect_list(F.struct("node", "pages", "same", "words", "text")).alias("nodes"))  # one skeleton's nodes

    def choose(batches):
        for batch in batches:
            content, constant, replies = [], [], []
            for text, rows in zip(batch.column("skeleton").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                stats = {r["node"]: (r["pages"], r["same"], r["words"], r["text"]) for r in rows}
                c, k, r = induce(bones(text), stats)
                content.append(c)
                replies.append([f"{at} {key}" for at, key in r])
                constant.append([at << 32 | stats[at][3] for at in k])  # the node and the hash of its text
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "group", "skeleton")), pa.array(content, pa.int32()), pa.array(constant, pa.list_(pa.int64())), pa.array(replies, pa.list_(pa.string()))], names=["host", "group", "skeleton", "content", "constant", "replies"])

    used = exemplars.withColumnRenamed("exemplar", "skeleton").join(nodes, ["host", "group"])
    wrappers = used.select("host", "group", "skeleton", "nodes").mapInArrow(choose, "host string, group long, skeleton string, content int, constant array<long>, replies array<string>")
    return groups.select("host", "layout", "group").join(materialize(wrappers, "wrappers"), ["host", "group"]).drop("group")


def extract(html: str | None, matcher: Matcher, tree: list[Bone] | None, content: int, constant: frozenset[int], replies: frozenset[str] = frozenset()) -> str:
    """The text of a page: below the node aligned with the wrapper's content node, without constant nodes and comments; else of the page's own best node."""
    root = parse(html)
    if tree is not None:
        pairs = matcher.match(matcher.number(bones_of(root))[0], tree[0])
        node = next((n.node for n, b in pairs if b.at == content), None)
        if node is not None:
            template = frozenset(id(n.node) for n, b in pairs if b.at << 32 | n.text in constant)
            left = frozenset(id(k.node) for n, b in pairs for k in n.kids if f"{b.at} {k.key}" in replies) if replies else frozenset()
            return "\n".join(blocks(node, template, left=left))
    return "\n".join(blocks(best_node(root), by_name=True))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Blocks of the content node in page order, joined by a line feed; inside a block
    references are decoded and white space is one space. What is the same on nearly all
    pages of a layout and what lies outside its content node is left out, as are menus,
    footers, forms and scripts. Null and empty html give an empty text; null addresses
    share one nameless host. Repeated rows give repeated rows and count once for the
    wrapper; an empty table gives an empty result; other columns are not read.
    """
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), layout_of(F.col("html")).alias("layout"))
    templates = materialize(host_templates(keyed), "templates")
    width = templates.agg(F.max(F.octet_length("skeleton") + F.octet_length("host") + 8 * F.size("constant") + F.octet_length(F.array_join("replies", " ")))).first()[0] or 0
    joined = joined_with(keyed, templates, ["host", "layout"], 64 + width)
    page_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        trees = _Trees()
        for batch in batches:
            texts = []
            for h, s, c, k, r in zip(*(batch.column(x).to_pylist() for x in ("html", "skeleton", "content", "constant", "replies")), strict=True):
                tree = trees.get(s) if s is not None else None
                texts.append(extract(h, trees.matcher, tree, c if c is not None else -1, frozenset(k or ()), frozenset(r or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return joined.select("page_id", "url", "html", "skeleton", "content", "constant", "replies").mapInArrow(run, f"page_id {page_type}, url string, text string, n_chars long")
