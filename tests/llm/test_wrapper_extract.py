"""Wrapper induction: page parsing, tree matching against plain recursion, template removal, grouping."""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import pytest

from estatelake.llm import wrapper_extract as W
from tests.conftest import SF_CHECK
from tests.llm.conftest import as_rows, clashing, expected

PAGES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a</p></div></p>b", "a\n\nb"), ("<script>x", ""),
    ("<p>one<br>two\n\t three</p>", "one two three"), ("<p>q &lt;x&gt; &#233;&nbsp;z &amp;amp; &copy;</p>", "q <x> é z &amp; ©"),
    ("<p title='a>b'>in</p><!-- <p>out</p> -->", "in"), ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\n\nd"),
    ("<nav><p>n</p></nav><article><h1>T</h1><p>x</article><footer>f</footer>", "T\n\nx"),
    ("<ul><li>a<li>b <b>c</b></ul>", "a\n\nb c"), ("<div class='ad-box'>x</div><p class='lead'>y</p>", "y"),
    ("<body class='has-sidebar'><p>y</p></body>", "y"), ("<div class='with-sidebar'><article><p>y</p></article></div>", "y"),
    ("<article><p>y</p><section id='comments'><article class='comment'><p>long long comment text</p></article></section></article>", "y"),
    ("<article><p>y</p><div role='alert'>n</div><div hidden>h</div><p style='display: none'>s</p></article>", "y"),
    ("<article><aside>a</aside><form><p>f</p><input></form>t</article>", "t"), ("<main><p>m</p></main><p>o</p>", "m"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"), ("<div><a href=x>Home</a> <a href=y>News</a></div><p>t <a href=z>l</a></p>", "t l"),
    ("<style>p{}</style><title>t</title><textarea>q</textarea><p>x</p>", "x"), ("a < b and c > d", "a < b and c > d"),
    ("<P>UP</P><DIV>case</DIV>", "UP\n\ncase"), ("<pre>a\n  b</pre>", "a b"), ("<div" * 500, ""), ("<div>" * 2000 + "deep", "deep"),
    ("<header><h1>Site</h1></header><div class=cookie-notice>We use</div><p>t</p>", "t"), ("<p>a</p>" * 3000, "\n\n".join(["a"] * 3000)),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_single_pages(page, text):
    assert W.extract([page or ""]) == [text]


def label(tree):
    return (tree.tag, tuple(label(c) for c in tree.children))


def plain_match(a, b):
    """Nodes in the largest order-preserving matching of two trees (pairs of equal tags)."""

    @lru_cache(None)
    def weigh(x, y):
        if x[0] != y[0]:
            return 0

        @lru_cache(None)
        def best(i, j):
            if i == len(x[1]) or j == len(y[1]):
                return 0
            return max(best(i + 1, j), best(i, j + 1), weigh(x[1][i], y[1][j]) + best(i + 1, j + 1))

        return 1 + best(0, 0)

    return weigh(label(a), label(b))


def random_tree(rng, depth=0):
    tag = rng.choice(["div", "p", "section", "ul"])
    inner = "".join(random_tree(rng, depth + 1) for _ in range(rng.randint(0, 4))) if depth < 3 and tag != "p" else "t"
    return f"<{tag}>{inner}</{tag}>"


def test_alignment_is_a_largest_matching():
    rng = random.Random(6)
    for _ in range(150):
        a, b = (W.parse("".join(random_tree(rng) for _ in range(rng.randint(0, 4)))) for _ in range(2))
        pairs = W.align(a, b)
        assert len(pairs) == plain_match(a, b)
        assert all(x.tag == y.tag for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def site(rng, n, body):
    words = ["w%02d" % i for i in range(60)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    out = []
    for _ in range(n):
        own = [say(rng.randint(5, 30)) for _ in range(rng.randint(1, 6))]
        out.append((body.format(content="".join(f"<p>{p}</p>" for p in own), say=say), own))
    return out


def test_constant_blocks_are_template():
    body = "<div><p>The Daily Example, since 1900</p></div><div>{content}</div><div><p>All rights kept by all of us</p><p>Call us any time</p></div>"
    pages = site(random.Random(1), 12, body)
    assert W.extract([p for p, _ in pages]) == ["\n\n".join(own) for _, own in pages]
    few = [p for p, _ in pages[:3]]  # too few witnesses: nothing is taken for template
    assert all("since 1900" in t for t in W.extract(few))
    assert all("since 1900" in t for t in W.extract([p for p, _ in pages], same_host=False))


def test_copies_and_shared_passages_stay():
    rng = random.Random(2)
    pages = site(rng, 10, "<article>{content}</article>")
    same = pages[0]
    shared = "a passage that four of the pages share word for word"
    some = [(p.replace("</article>", f"<p>{shared}</p></article>"), own + [shared]) for p, own in pages[1:5]]
    every = [same] * 40 + some + pages[5:]
    assert W.extract([p for p, _ in every]) == ["\n\n".join(own) for _, own in every]


def plain_articles(page):
    found = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1])
    return "\n\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks) if t)


def test_driver_pages(spark):
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    want = expected([(r["page_id"], r["url"], plain_articles(r["html"])) for r in pages.collect()])
    assert as_rows(W.main_texts(pages), "id", "url", "text") == want
    assert as_rows(W.main_texts(clashing(pages), group=5), "id", "url", "text") == want


def test_rows_are_kept(spark):
    rows = [(i, "http://h.org/", p) for i, (p, _) in enumerate(PAGES)] + [(1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (None, "http://h.org/", "<p>y</p>")]
    out = W.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), group=4)
    got = as_rows(out, "id", "url", "text")
    assert len(got) == len(rows) and got.count((1, None, "x")) == 2 and (None, "http://h.org/", "y") in got
    assert W.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


WHOLE = [
    ("<main><h1>Head</h1><p>lead</p><article><p>one</p></article><article><p>two, longer</p></article></main><p>out</p>", "Head\n\nlead\n\none\n\ntwo, longer"),
    ("<div><h1>Head</h1><article><p>one</p></article><div><a href=x>link</a></div><article><p>two</p></article></div>", "Head\n\none\n\ntwo"),
    ("<article><p>y</p><section id='comments'><article><p>long long comment text</p></article></section></article>", "y"),
    ("<div class='with-sidebar'><article><p>y</p></article><aside><article><p>teaser</p></article></aside></div>", "y"),
]


@pytest.mark.parametrize("page,text", WHOLE)
def test_all_articles_and_what_is_around(page, text):
    assert W.extract([page]) == [text]


def test_long_boilerplate_is_template():
    legal = "all of this is law " * 60
    pages = site(random.Random(3), 12, "<div>{content}</div><div><p>" + legal + "</p><p>x</p></div>")
    assert W.extract([p for p, _ in pages]) == ["\n\n".join(own) for _, own in pages]
    copies = [f"<div><p>{legal}</p><p>{legal} too</p></div><div><p>views {i}</p></div>" for i in range(12)]
    assert all(t.startswith(legal.strip()) for t in W.extract(copies))  # copies of one article, whose count varies


def test_layouts_and_sections():
    one = "<div><p>The one paper of the town</p>{content}</div>"
    two = "<section><table><tr><td>Second layout</table><ul><li>{content}</ul><div><h2>Call us</h2><p>any time</p></div></section>"
    rng = random.Random(4)
    for a, b in ((one, two), (one, one.replace("one paper", "two papers"))):
        pages = site(rng, 16, a) + site(rng, 16, b)
        assert W.extract([p for p, _ in pages]) == ["\n\n".join(own) for _, own in pages]


def test_deep_pages_keep_their_parts():
    deep = "<div>" * 3000
    assert W.extract([deep + "<nav><p>n</p></nav><p>t</p><footer>f</footer>"]) == ["t"]
    assert W.extract([deep + "<main><article><p>a</p></article></main><p>o</p>"]) == ["a"]
    trees = [W.parse(deep + "<p>a</p><p>b</p>"), W.parse(deep + "<p>a</p>")]
    assert len(W.align(*trees)) == 3002


def test_long_lists_are_matched_in_full():
    rng = random.Random(5)
    tags = ["p", "h2", "pre", "blockquote"]
    for _ in range(5):
        a, b = ([rng.choice(tags) for _ in range(rng.randint(80, 160))] for _ in range(2))
        best = [0] * (len(b) + 1)  # longest common subsequence
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(max(row[-1], best[j + 1], best[j] + (x == y)))
            best = row
        trees = [W.parse("".join(f"<{t}>x</{t}>" for t in own)) for own in (a, b)]
        pairs = W.align(*trees)
        assert len(pairs) == 1 + best[-1]
        order = {id(c): i for t in trees for i, c in enumerate(t.children)}
        places = [(order[id(x)], order[id(y)]) for x, y in pairs[1:]]
        assert all((p < q) == (r < s) for (p, r), (q, s) in zip(sorted(places), sorted(places)[1:]))
    long = [f"<ul><li>{i}</ul>" + "<h2>h</h2>" * (1500 + 200 * i) + "<ul><li>template at the end</ul><pre>t</pre>" for i in range(2)]
    x, y = (W.parse(p) for p in long)
    assert "template at the end" in {p.text for p, q in W.align(x, y) if p.text == q.text}


@pytest.mark.parametrize(("html", "text"), [
    ('<article><p class=a">first text here</p><p class=b">second text here</p></article>', "first text here\n\nsecond text here"),
    ("<article><p title='a>b'>one</p><p title=\"a'>b\" class = 'x'>two</p><p a=1 b='2'c=\"3\">three</p></article>", "one\n\ntwo\n\nthree"),
    ("<article><p>it's <b title=don't>five</b> o'clock</p><p>\"quoted\" text</p></article>", "it's five o'clock\n\n\"quoted\" text"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p></article>", "Let x=1 be."),
    ('<article><p>An <svg viewBox="0 0 1 1"><title>icon</title><path d="M0"/></svg> icon.</p></article>', "An icon."),
], ids=["stray quotes", "quotes", "apostrophes", "math", "drawing"])
def test_no_article_text_is_lost(html, text):
    assert W.extract([html]) == [text]
