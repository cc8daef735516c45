"""Main text of pages by wrapper induction over the pages of a host.

Each page becomes a tree of its blocks.  Elements whose tag, role, class or id names a menu,
header, footer, sidebar, notice, advert, form, script, style or reader comment are cut away, unless
they hold the article itself.  The trees of up to about ``GROUP`` pages of a host are then
aligned with one of them by simple tree matching (an order-preserving matching of equal tags that
pairs most nodes, whatever the depth of the trees and the length of their child lists), and so are the pages of each layout among them.  A node whose text is the same in ``CONSTANT`` of the pages is
template, as are the texts of a node that has only texts of ``SECTION`` of the pages each in so many of them;
the rest are varying slots and thus content.  Pages that share their longest block, apart from blocks of most pages, are
copies and bear witness once, and ``WITNESSES`` pages at least are needed, so copied
articles are not mistaken for template.  The content is what lies in the page's articles and
main elements, in page order; without a main element also the body around the articles, where blocks that are mostly links go.

A host with more than ``GROUP`` pages is dealt into as many groups as it needs, so
a host with a third of all pages spreads over the cluster; every page is in one group.

Defined results: a null or empty page has an empty text; a null URL or one without a host
joins no alignment; repeated rows each get their own result; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage, small
from estatelake.llm.url_filter import host_and_path
from estatelake.session import ship_package

GROUP = 64
WITNESSES = 5
CONSTANT = 0.9
SECTION = 0.25  # a section's own template is on this part of the witnesses at least
OWN = 5  # words that a page's own longest block has at least, else the page is a copy
CELLS = 4096  # larger tables of child lists are halved before they are matched

# Names from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp template noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption dd dt head html legend li summary tbody tfoot thead tr".split())
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "p": "p"}  # a start tag that ends an open one
DRAWINGS = frozenset(["svg"])  # stand in the line of text, without text of their own
LISTS = frozenset("ul ol dl menu table".split())  # an open item outside of these is not ended
JUNK_TAGS = frozenset("nav footer aside form dialog menu search button select object canvas audio video map".split()) | RAW | {"head"}
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

# Words in a class or id that name something beside the article.
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner banners "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices alert alerts disclaimer copyright popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended teaser teasers comment comments commentlist respond reply replies disqus form search widget "
    "widgets skip".split()
)
ARTICLE_WORDS = frozenset("comment comments commentlist reply ad ads advert related recommended promo sponsored teaser".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^>\s]*+))*+)>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block: its tag, its child blocks, or (a leaf) its text and how much of it is links."""

    __slots__ = ("children", "core", "junk", "linked", "tag", "text")

    def __init__(self, tag: str, junk: bool = False, text: str | None = None, linked: int = 0):
        self.tag, self.junk, self.text, self.linked = tag, junk, text, linked
        self.children: list[Node] = []
        self.core = tag in ("article", "main")  # is or holds an article


def named_junk(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is beside the article by its tag, role, class or id."""
    if tag in JUNK_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    got = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true" or got.get("role", "").lower() in JUNK_ROLES:
        return True
    if "display:none" in re.sub(r"\s", "", got.get("style", "")).lower():
        return True
    words = {w.lower() for w in WORD.findall(got.get("class", "") + " " + got.get("id", ""))}
    if tag == "article":
        return bool(words & ARTICLE_WORDS)
    return bool(words & JUNK_WORDS) or "header" in words and not in_article


def parse(page: str) -> Node:
    """The tree of a page's blocks; all text is in leaves."""
    root = Node("html")
    stack, said, link, linked = [root], [], False, 0
    opened: Counter[str] = Counter()  # tags on the stack above the root

    def text_ends() -> None:
        nonlocal said, linked
        if said:
            text = " ".join("".join(said).split())
            if text:
                stack[-1].children.append(Node("#text", text=text, linked=linked))
            said, linked = [], 0

    def pop() -> None:
        text_ends()
        done = stack.pop()
        opened[done.tag] -= 1
        if done.core:
            stack[-1].core = True
        only = done.children[0] if len(done.children) == 1 else None
        if only is not None and only.tag == "#text":  # a block of nothing but text is a leaf
            done.text, done.linked, done.children = only.text, only.linked, []

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        chunk = page[at : found.start() if found else end]
        if chunk:
            chunk = references.unescape(chunk)
            said.append(chunk)
            linked += len(chunk.strip()) if link else 0
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                link = False
            elif tag in ("td", "th"):
                said.append(" ")
            elif opened[tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag == "br" or tag in ("td", "th"):
            said.append(" ")
        elif tag == "a":
            link = True
        elif tag in BLOCKS or tag in JUNK_TAGS or tag == "hr":
            link = False
            text_ends()
            ended = (SIBLINGS.get(tag, "") + (" p" if tag in CLOSES_P else "")).split()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ended:
                    while len(stack) > i:
                        pop()
                    break
                if stack[i].tag in LISTS or stack[i].tag not in ("p", "li", "dt", "dd", "tr"):
                    break
            junk = named_junk(tag, attributes, opened["article"] > 0)
            if tag in RAW:  # no markup inside
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end
            elif tag not in VOID and not attributes.endswith("/"):
                node = Node(tag, junk)
                stack[-1].children.append(node)
                stack.append(node)
                opened[tag] += 1
        elif tag in DRAWINGS or attributes and named_junk(tag, attributes, opened["article"] > 0) and tag not in VOID:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else at  # an inline element beside the article
    while len(stack) > 1:
        pop()
    text_ends()
    return root


def prune(node: Node) -> Node:
    """The tree without what is beside the article."""
    todo = [node]
    while todo:
        top = todo.pop()
        top.children = [c for c in top.children if not (c.junk and (c.tag == "article" or not c.core))]
        todo += top.children
    return node


def leaves(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        top = stack.pop()
        if top.text is not None:
            yield top
        stack.extend(reversed(top.children))


class Shapes:
    """Trees without their texts: each shape, a tag and the shapes of the children, has one number."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.tags: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.weights: dict[tuple[int, int], int] = {}
        self.matched: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def of(self, root: Node) -> dict[int, int]:
        """The shape of each node of a tree, by the node's ``id``."""
        order, todo, out = [], [root], {}
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.children
        for node in reversed(order):
            key = (node.tag, *(out[id(c)] for c in node.children))
            number = self.numbers.setdefault(key, len(self.tags))
            if number == len(self.tags):
                self.tags.append(node.tag)
                self.children.append(key[1:])
            out[id(node)] = number
        return out

    def weigh(self, x: int, y: int) -> int:
        """The number of pairs in the largest matching of two shapes; that of their inner children is known."""
        if self.tags[x] != self.tags[y]:
            return 0
        return self.weights[x, y] if self.children[x] and self.children[y] else 1

    def solve(self, x: int, y: int) -> None:
        """Match two shapes of equal tags, and before them all their descendants that may pair."""
        todo = [(x, y)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self.weights or not self.children[x] or not self.children[y]:
                todo.pop()
                continue
            inner = [[c for c in dict.fromkeys(self.children[z]) if self.children[c]] for z in (x, y)]
            open_ = [(p, q) for p in inner[0] for q in inner[1] if self.tags[p] == self.tags[q] and (p, q) not in self.weights]
            if open_:
                todo += open_
                continue
            pairs = self.match(self.children[x], self.children[y])
            self.matched[x, y] = pairs
            self.weights[x, y] = 1 + sum(self.weigh(self.children[x][i], self.children[y][j]) for i, j in pairs)
            todo.pop()

    def match(self, a: tuple[int, ...], b: tuple[int, ...]) -> list[tuple[int, int]]:
        """The order-preserving pairs (places in ``a`` and ``b``) of equal tags with the largest total weight."""
        pairable = lambda x, y: self.tags[x] == self.tags[y] and not self.children[x] and not self.children[y]
        head, most = 0, min(len(a), len(b))
        while head < most and pairable(a[head], b[head]):
            head += 1  # equal leaves at the start, or at the end, pair up in some best matching
        tail = 0
        while tail < most - head and pairable(a[-1 - tail], b[-1 - tail]):
            tail += 1
        pairs = [(i, i) for i in range(head)]
        parts = [(head, len(a) - tail, head, len(b) - tail)]
        while parts:
            i, k, j, m = parts.pop()
            if (k - i) * (m - j) <= CELLS or k - i == 1:
                pairs += [(i + p, j + q) for p, q in self.table(a[i:k], b[j:m])]
                continue
            # Halve `a`; the best place to part `b` joins the best of both halves (Hirschberg).
            half = (i + k) // 2
            total = self.last_row(a[i:half], b[j:m]) + self.last_row(a[half:k][::-1], b[j:m][::-1])[::-1]
            cut = j + int(total.argmax())
            parts += [(half, k, cut, m), (i, half, j, cut)]
        return pairs + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]

    def last_row(self, a: tuple[int, ...], b: tuple[int, ...]) -> np.ndarray:
        """The largest weights of ``a`` against each beginning of ``b``."""
        kinds, which = np.unique(np.array(b, np.int64), return_inverse=True)
        row, known = np.zeros(len(b) + 1, np.int64), {}
        for x in a:
            if x not in known:
                known[x] = np.array([self.weigh(x, y) for y in kinds.tolist()], np.int64)
            row[1:] = np.maximum(row[1:], row[:-1] + known[x][which])
            np.maximum.accumulate(row, out=row)
        return row

    def table(self, a: tuple[int, ...], b: tuple[int, ...]) -> list[tuple[int, int]]:
        """``match`` by the full table."""
        best = [[0] * (len(b) + 1)]
        for x in a:
            above, row, left = best[-1], [0], 0
            for j, y in enumerate(b):
                left = max(left, above[j + 1], above[j] + self.weigh(x, y))
                row.append(left)
            best.append(row)
        i, j, back = len(a), len(b), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                back.append((i, j))
        return back[::-1]


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: the paired nodes of two trees with equal root tags."""
    shapes = Shapes()
    of = shapes.of(a) | shapes.of(b)
    shapes.solve(of[id(a)], of[id(b)])
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        if x.children and y.children:
            todo += [(x.children[i], y.children[j]) for i, j in shapes.matched[of[id(x)], of[id(y)]]]
    return out


def content(root: Node) -> list[Node]:
    """The leaves of all articles and main elements; without a main, also those around the articles but for link lists.

    An article inside a menu, sidebar, comment list or the like counts only if no other article lies further out.
    """
    todo, places, levels = [(root, 0, False, False)], [], {"article": [], "main": []}
    while todo:
        node, level, in_article, in_main = todo.pop()
        level += node.junk
        if node.tag in levels:
            levels[node.tag].append(level)
        in_article, in_main = in_article or node.tag == "article", in_main or node.tag == "main"
        if node.text is not None:
            places.append((node, level, in_article, in_main))
        todo.extend((c, level, in_article, in_main) for c in reversed(node.children))
    least = min(levels["article"] or levels["main"] or [0])
    around = not levels["main"]
    return [
        x for x, level, in_article, in_main in places
        if level <= least and (in_article or in_main or around and 2 * x.linked <= len(x.text))
    ]


def bear_witness(kept: dict[str, list[Node]]) -> list[str]:
    """One page of each set of copies: pages that share their longest block, apart from blocks that most pages have."""
    differing = {tuple(x.text for x in own): p for p, own in kept.items()}
    having = Counter(text for texts in differing for text in set(texts))
    witnesses = {}
    for texts, p in differing.items():
        own = max((t for t in texts if 2 * having[t] <= len(differing)), key=len, default="")
        # Pages that differ in no more than a date or a count are copies still.
        witnesses[own if len(own.split()) >= OWN else max(texts, key=len, default="")] = p
    return sorted(witnesses.values(), key=lambda p: (len(kept[p]), p))


def layouts(trees: dict[str, Node]) -> list[list[str]]:
    """Pages by layout: those whose sets of paths to inner blocks have half in common with those of a layout's first page."""
    found: list[tuple[frozenset, list[str]]] = []
    for p, tree in trees.items():
        paths, todo = set(), [(tree, 0)]
        while todo:
            node, above = todo.pop()
            if node.children:
                path = hash((above, node.tag))  # equal within one process, which is all that is needed
                paths.add(path)
                todo.extend((c, path) for c in node.children)
        mine = frozenset(paths)
        like = next((own for first, own in found if 2 * len(first & mine) >= len(first | mine)), None)
        if like is None:
            found.append((mine, [p]))
        else:
            like.append(p)
    return [own for _, own in found]


def constants(trees: dict[str, Node], seen: list[str]) -> dict[str, set[int]]:
    """For each page the leaves that are template by the witnesses ``seen``: at their place, recurring texts hold ``CONSTANT`` of them."""
    reference = trees[seen[len(seen) // 2]]
    paired = {p: [(r, x) for r, x in align(reference, t) if r.text is not None and x.text is not None] for p, t in trees.items()}
    said: dict[int, Counter] = {}
    for p in seen:
        for r, x in paired[p]:
            said.setdefault(id(r), Counter())[x.text] += 1
    least = max(WITNESSES, SECTION * len(seen))
    # A text that nearly all have, or the few texts that the sections of a site have in that place.
    recurring = {r: {t for t, n in texts.items() if n >= least or n >= CONSTANT * len(seen)} for r, texts in said.items()}
    fixed = {r for r, texts in said.items() if sum(texts[t] for t in recurring[r]) >= CONSTANT * len(seen)}
    return {p: {id(x) for r, x in own if id(r) in fixed and x.text in recurring[id(r)]} for p, own in paired.items()}


def extract(pages: list[str], same_host: bool = True) -> list[str]:
    """The main texts of pages of one host."""
    trees = {p: prune(parse(p)) for p in sorted(set(pages))}
    kept = {p: content(t) for p, t in trees.items()}
    template: dict[str, set[int]] = {p: set() for p in trees}
    if same_host and len(trees) >= WITNESSES:
        groups = [own for own in layouts(trees) if len(own) >= WITNESSES]
        if groups != [list(trees)]:
            groups.append(list(trees))
        for group in groups:
            seen = bear_witness({p: kept[p] for p in group})
            if len(seen) >= WITNESSES:
                for p, fixed in constants({p: trees[p] for p in group}, seen).items():
                    template[p] |= fixed
    texts = {p: "\n\n".join(x.text for x in own if id(x) not in template[p]) for p, own in kept.items()}
    return [texts[p] for p in pages]


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = GROUP) -> DataFrame:
    """``id, url, text`` for every row."""
    ship_package(pages.sparkSession)
    host, _ = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    large = rows.groupBy("host").count().where(F.col("count") > group)
    large = cut_lineage(large.select(F.col("host").alias("h"), F.ceil(F.col("count") / group).alias("groups")))
    dealt = rows.join(small(large), F.col("host") == F.col("h"), "left")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id", "url", "html"), F.coalesce("groups", F.lit(1))))

    def extracted(table: pa.Table) -> pa.Table:
        named = bool(table.column("host")[0].as_py())
        texts = extract([h or "" for h in table.column("html").to_pylist()], named)
        return pa.table({"id": table.column("id"), "url": table.column("url"), "text": pa.array(texts, pa.string())})

    dealt = dealt.select("id", "url", "html", "host", "part")
    return dealt.groupBy("host", "part").applyInArrow(extracted, "id long, url string, text string")
