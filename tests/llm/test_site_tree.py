"""Main text of pages: the parser on awkward markup, the style tree on sites whose names give nothing away."""

import html
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import site_tree as S


def text(page, removed=()):
    return S.text_of(page, set(removed))


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, ""), ("", ""), ("plain <b>text</b>", "plain text"), ("a < b &lt;c&gt; &eacute;&#x41;&#66; &am &ampx", "a < b <c> éAB &am &x"),
        ("<p>one\n two<br>three\t</p><p>four", "one two three\nfour"), ("<div>a<p>b</div>c", "a\nb\nc"), ("<p>x<!-- <p>y</p> -->z</p>", "xz"),
        ("<p>a</p><script>var t='</p><p>no';</script><style>p{}</style><p>b", "a\nb"), ("<p>a<p title='>' class=\"x>y\">b", "a\nb"),
        ("<p>a</p><p cl", "a"), ("<p>a</p><!-- open", "a"), ("<p>a</p><p class=\"open>b</p>", "a\nb"), ("<P>Up</P><Script>no</sCRIPT >yes", "Up\nyes"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"), ("<title>no</title><h1>a&nbsp; b</h1>", "a b"),
        ("<head><title>t</title><p>a</p>", "a"), ("<html><head><meta x></head><body class='has-sidebar'><p>a</p></body></html>", "a"),
        ("<nav>m</nav><header>h</header><aside>s</aside><form>f</form><p>a</p><footer>z</footer>", "a"),
        ("<div class='cookie-notice'>c</div><div id=sidebar>s</div><div class='ad'>x</div><p>a</p><div class='reader-comments'><p>c</p></div>", "a"),
        ("<p>out</p><article><header><h1>t</h1></header><p>a</p><footer>by</footer></article><p>out</p>", "t\na"),
        ("<main><h1>t</h1><p>a</p></main><p>out</p>", "t\na"), ("<main><article><p>a</p></article><p>other</p></main>", "a"),
        ("<article><p>a</p></article><section class=comments><article class=comment><p>c</p></article><article>d</article></section>", "a"),
        ("<form id=f><article><p>a</p></article></form>", "a"), ("<div class='header'><article><p>a</p></article></div>", "a"),
        ("<nav><ul><li>m<article><p>a</p></article>", "a"), ("<div hidden>h</div><div style='display: none'>n</div><p aria-hidden=true>n</p><p>a</p>", "a"),
        ("<article><p>a <button>share</button> b <svg><text>s</text></svg></p></article>", "a\nb"), ("<div class='post-header'><h1>t</h1></div><p>a", "t\na"),
    ],
)
def test_pages(page, expected):
    assert text(page) == expected


def test_parser_is_linear():
    for part in ("<a ", "<p>", "<div>", "<div class='", '<a "\'', "&amp", "<", "<!--", "</p>", "<b class=x>", "<script>", "<nav>"):
        start = time.perf_counter()
        text(part * (400_000 // len(part)))
        assert time.perf_counter() - start < 20, part


def test_nothing_of_an_article_is_lost():
    rng = random.Random(3)
    for _ in range(200):
        words = ["".join(rng.choices("abc<&é  \n", k=rng.randint(1, 12))) for _ in range(rng.randint(1, 30))]
        page = "<nav>x</nav><article>" + "".join(f"<p><i>{html.escape(w)}</i></p>" for w in words) + "</article><footer>y</footer>"
        assert text(page) == "\n".join(t for t in (" ".join(w.split()) for w in words) if t)


def neutral_site(rng, host, n, menu, notice):
    """Pages of nameless boxes: a menu, a notice and a footer that vary little, a text that varies."""
    pages, texts = [], []
    sentence = lambda k: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(k))
    for i in range(n):
        paragraphs = [sentence(20) for _ in range(rng.randint(1, 6))]
        boxes = f"<div class=b1>{menu}</div><div class=b2>{rng.choice(notice)}</div><div class=b3>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        pages.append((f"https://{host}/p{i}", f"<html><body>{boxes}</div><div class=b4>about {host}</div></body></html>"))
        texts.append("\n".join(paragraphs))
    return pages, texts


@pytest.fixture(scope="module")
def sites():
    rng = random.Random(11)
    pages, texts = [], []
    for host, n in (("a.example", 120), ("b.example", 40), ("c.example", 2), ("d.example", 1)):
        own, expected = neutral_site(rng, host, n, f"home news {host}", ["accept all", "we use cookies", "sale"])
        pages, texts = pages + own, texts + expected
    return pages, texts


def test_style_tree_removes_what_repeats(spark, sites):
    pages, texts = sites
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)]
    rows += [(1000 + i, u, h) for i, (u, h) in enumerate(pages[:50])]  # copies count once
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r for r in S.extract(df).collect()}
    assert len(got) == len(rows)
    for i in range(160):
        assert got[i].text == texts[i] and got[i].n_chars == len(texts[i])
    assert all(got[1000 + i].text == texts[i] for i in range(50))
    # A site of one or two pages shows nothing; its pages stay whole.
    assert "home news c.example" in got[160].text and texts[162] in got[162].text


def expected_importance(pages):
    """The tree's figures written out plainly."""
    seen = {h: S.parse(h) for _, h in set(pages)}
    host = {h: re.search("//([^/]+)", u)[1] for u, h in pages}
    held, where, styles = defaultdict(set), defaultdict(set), defaultdict(Counter)
    above = {}
    for h, page in seen.items():
        for b, left, flow in S.judged(page):
            if left and not flow:
                path = tuple(e.node for e in b.path)
                above[host[h], path[-1]] = path
                held[host[h], path[-1], b.text].add(h)
                where[host[h], path[-1]].add(h)
        for n, s in page.styles.items():
            if s != {()}:
                styles[host[h], n][tuple(sorted(s))] += 1
    worth, m = defaultdict(list), defaultdict(int)
    for (site, node, _), on in held.items():
        k = len(where[site, node])
        for e in above[site, node]:
            worth[site, e].append(1 - math.log(len(on)) / math.log(k) if k > 1 else 1)
            m[site, e] = max(m[site, e], k)
    out = {}
    for key, shares in worth.items():
        content = sum(shares) / len(shares)
        n = styles.get(key)
        if n:
            total = sum(n.values())
            looks = -sum(c / total * math.log(c / total, total) for c in n.values()) if total > 1 else 1
            content = (1 - S.DECAY ** len(n)) * looks + S.DECAY ** len(n) * content
        out[key] = (m[key], content)
    return out


def test_importance_by_brute_force(spark, sites):
    pages = sites[0][:170]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {(r.host, r.node): (r.pages, r.importance) for r in S.importance(S.style_rows(df)).collect()}
    expected = expected_importance(pages)
    assert set(got) == set(expected) and all(got[k] == (v[0], pytest.approx(v[1])) for k, v in expected.items())


def test_awkward_rows(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [
        (1, None, None), (1, None, None), (None, "no host", "<p>a</p>"), (3, "http://h.example", ""), (4, "http://H.example:80/x", "<p>퟿ &#0; &#x110000;</p>"),
        (5, "http://u@h.example", "<article>" + "<p>w w</p>" * 50_000 + "</article>"), (6, "http://h.example", deep), (7, "http://h.example", "<nav>only</nav>"),
    ]
    wide = "page_id long, url string, html string, host string, nodes string, text string, rid int"
    df = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], wide)
    got = S.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = Counter((r.page_id, r.text[:9], r.n_chars) for r in got.collect())
    assert found == Counter([(1, "", 0), (1, "", 0), (None, "a", 1), (3, "", 0), (4, "퟿ � �", 5), (5, "w w\nw w\nw", 199_999), (6, "x", 1), (7, "", 0)])
    assert S.extract(df.limit(0)).collect() == []
    assert [r[0] for r in df.select(S.host_of(F.col("url"))).collect()][3:6] == ["h.example"] * 3


def test_given_pages(spark):
    """Every given page holds one article, whose text is known by its tags."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in S.extract(df).collect()}
    for r in df.collect():
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", r.html, re.S)[1])
        clean = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts)
        assert got[r.page_id] == "\n".join(c for c in clean if c)
