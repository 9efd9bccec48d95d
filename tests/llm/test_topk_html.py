from __future__ import annotations

import html.parser
import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from compare import TINY, same_as_sql
from pyspark.sql import functions as F

from tidemark.llm import html_text, queries, top_k

VECTORS = "vec_id long, embedding array<float>"


def brute_top(rows, step: int, k: int):
    """Sorted (query_id, rank, vec_id, score); shorter vectors are zero in the missing components, scores end at those of a long."""
    whole = lambda x: int(x) * 256 if abs(x) > 2.0**60 else int(np.floor(np.float64(x) * 256))
    good = [(i, [whole(x) for x in v]) for i, v in rows if v and i is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for a, (i, q) in enumerate(good):
        if i % step == 0:
            score = lambda x: min(max(sum(m * n for m, n in zip(q, x)), -(1 << 63)), (1 << 63) - 1)  # noqa: E731, B023
            best = sorted((-score(x), j) for b, (j, x) in enumerate(good) if a != b)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_top_k_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(top_k, "SEEDS", 7)
    monkeypatch.setattr(top_k, "GROUP", 1 + 2 * seed)
    r = np.random.default_rng(seed)
    x = (r.normal(size=(300, 24)) * r.lognormal(0, 1, (300, 1))).astype(np.float32)
    x[10:40] = x[10]  # ties go to the smaller id
    x[50] = 0
    rows = [(int(i), [float(v) for v in x[i]]) for i in r.permutation(300)]
    rows += [(400, None), (405, [float("nan")] * 24), (410, [None] + [1.0] * 23), (415, [float("inf")] + [1.0] * 23), (None, [1.0] * 24), (420, []), (425, [1.0] * 3)]
    rows += [(20, [1.0] * 24), (20, [1.0] * 24), (7, [float(v) for v in x[7]]), (0, [0.5] * 30)]  # repeated ids, one with other vectors
    got = top_k.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0, query_block=9, range_rows=40)
    assert sorted((q["query_id"], q["rank"], q["vec_id"], q["score"]) for q in got.collect()) == brute_top(rows, 5, 5)


def test_large_components(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=5) * 10.0 ** r.integers(-2, 39 if i % 3 else 9)]) for i in range(60)]
    got = top_k.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0)
    assert sorted((q["query_id"], q["rank"], q["vec_id"], q["score"]) for q in got.collect()) == brute_top(rows, 5, 5)


def test_components_at_the_end_of_doubles(spark, monkeypatch):
    """Their squares overflow; they and all other rows still meet, exactly."""
    monkeypatch.setattr(top_k, "LARGE_BLOCK", 3)
    r = np.random.default_rng(4)
    rows = [(i, [float(v) for v in r.normal(size=4)]) for i in range(40)] + [(i, [float(v) for v in r.normal(size=4) * 10.0**e]) for i, e in enumerate((306, 160, 150, 139, 141, 300, 20), 40)]
    rows += [(50, [1e306, -1e306, 1.0, 0.5]), (51, [1.0, 1.0, 2.0, 3.0]), (52, [1.7e308, 0.0, 0.0, -1.7e308]), (55, [1e306, 1e306, 0.25, 0.0]), (55, [1e306, 1e306, 0.25, 0.0])]
    schema = "vec_id long, embedding array<double>"
    got = top_k.top_k(spark.createDataFrame(rows, schema).repartition(3), F.col("vec_id") % 5 == 0)
    assert sorted((q["query_id"], q["rank"], q["vec_id"], q["score"]) for q in got.collect()) == brute_top(rows, 5, 5)
    only = spark.createDataFrame([(0, [1e306]), (1, [-1e306])], schema)
    assert sorted(map(tuple, top_k.top_k(only, F.col("vec_id") == 0).collect())) == [(0, 1, 1, -(1 << 63))]


def test_few_or_no_vectors(spark):
    assert top_k.top_k(spark.createDataFrame([], VECTORS), F.lit(True)).collect() == []
    two = spark.createDataFrame([(0, [1.0, 2.0], "a"), (1, [0.5, 0.25], "b")], VECTORS + ", q string")
    assert sorted(map(tuple, top_k.top_k(two, F.lit(True)).collect())) == [(0, 1, 1, 256 * 128 + 512 * 64), (1, 1, 0, 256 * 128 + 512 * 64)]
    assert top_k.top_k(two.where("vec_id = 0"), F.lit(True)).collect() == []


def test_top_k_query_equals_sql(spark):
    assert same_as_sql(spark, queries.QUERIES["op4_exact_top_k"], queries.SQL["op4_exact_top_k"]) == 50


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><h1>Title &amp; {n}</h1><p>First&nbsp;block   of <b>page</b> {n}
goes on.<p>Second &#x2014; block<br>line</p><div class="ad">Buy now</div><ul><li>one<li>two</ul><form><input>Sign up</form></article>
<section id="comments"><p>Reader {n} says hello</p></section></main><aside>Related</aside><div><span>Made by site</span></div><footer>Copyright</footer></body></html>"""


def test_main_text_of_a_site(spark):
    rows = [(n, f"https://example.org/{n}", PAGE.format(n=n), "x") for n in range(20)]
    rows += [(50, None, None, "x"), (51, "https://example.org/e", "", "x"), (52, "::bad", "just &lt;text&gt;", "x"), (53, None, "<p>a<p>b", "x"), (None, "https://example.org/0", PAGE.format(n=0), "x")]
    out = {r["page_id"]: r for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert len(out) == len(rows)
    for n in range(20):
        text = f"Title & {n}\nFirst block of page {n} goes on.\nSecond — block line\none\ntwo"
        assert out[n]["text"] == text and out[n]["n_chars"] == len(text) and out[n]["host"] == "x"
    assert [out[k]["text"] for k in (50, 51, 52, 53)] == ["", "", "just <text>", "a\nb"]


def test_templates_without_a_name_go_by_their_count(spark):
    page = "<html><body><div><em>Site of sites</em> since ever</div><div><p>Own words {n} of the page</p></div></body></html>"
    rows = [(n, "http://a.b/" + str(n), page.format(n=n)) for n in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {n: f"Own words {n} of the page" for n in range(30)}
    assert {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()} == want
    assert {r["page_id"]: r["text"] for r in html_text.main_text(df, small=0).collect()} == want  # joined instead of broadcast
    few = html_text.main_text(df.limit(2)).collect()  # two pages tell no template
    assert all("Site of sites" in r["text"] for r in few)
    assert all("Site of sites" not in r["text"] for r in html_text.main_text(df.limit(5)).collect())
    assert html_text.main_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("page", ["<div class=wrap><article><h1>T</h1><div class=body><p>Copied text</p></div></article></div>", "<nav>Menu {n}</nav><div class=body><h1>T</h1><p>Copied text</p></div><footer>{n}</footer>"])
def test_copied_pages_keep_their_text_and_templates_go_on_large_hosts(spark, page):
    own = "<body><div><em>Box</em> of the site</div><div><p>Own words {n} here</p></div></body>"
    rows = [(n, "http://a.b/" + str(n), f"<body>{page.format(n=n)}</body>") for n in range(12)]
    rows += [(100 + n, "http://a.b/" + str(n), own.format(n=n) if n < 12 else f"<body><p>Other {n}</p></body>") for n in range(1500)]
    out = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {out[n] for n in range(12)} == {"T\nCopied text"}
    assert [out[100 + n] for n in range(12)] == [f"Own words {n} here" for n in range(12)]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><div class="search-results"><p>one</p></div><div class="related-work">two</div><p class="share-price">three</p></article>', "one\ntwo\nthree"),
        ('<body><div id="alert-systems"><article><p>kept</p></article></div></body>', "kept"),
        ('<body><main><h1>Head</h1><article><p>kept</p></article><p>tail</p></main></body>', "Head\nkept\ntail"),
        ('<article><p class="a" "b>one<p title="x > y">two<p title=\'>\' >three</article>', "one\ntwo\nthree"),
        ('<article><div class="relatedPosts">no</div><div class="x ad-slot-3">no</div><div id="comment_12">no</div><div class="post-header"><h1>yes</h1></div></article>', "yes"),
        ('<main><article><p>yes</p></article><div id="disqus_thread">no</div><div class="comments-area">no</div><section class="cookie-notice-bar sticky">no</section><div class="lead-in">also</div></main>', "yes\nalso"),
        ('<body><div class="site-header">no</div><p>yes &lt;&amp; &#233;</p><aside>no</aside><div role="dialog">no</div></body>', "yes <& \u00e9"),
    ],
)
def test_pages_with_known_text(page, text):
    own = html_text._Page(page)
    assert own.text(np.zeros(len(own.tags) - 1, bool)) == text


class Tree(html.parser.HTMLParser):
    """The elements of a well-formed page, as nested lists of tag, attributes and children."""

    def __init__(self, source: str):
        super().__init__()
        self.root: list = ["#", "", []]
        self.path = [self.root]
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        self.path[-1][2].append([tag, str(attrs), []])
        self.path.append(self.path[-1][2][-1])

    def handle_endtag(self, tag):
        assert self.path.pop()[0] == tag

    def handle_data(self, data):
        self.path[-1][2].append(data)


def test_templates_equal_brute_force(spark):
    r = random.Random(4)
    phrase = lambda n: " ".join(r.choice("sun tea lake road hill stone".split()) for _ in range(n))
    boxes = [f"<div><span>{phrase(3)} {i}</span></div>" for i in range(12)]
    rows, trees = [], []
    for n in range(90):
        host = "h%d.org" % (0 if n < 50 else 1 + n % 5)
        own = "".join(r.choice([*boxes, f"<div><p>{phrase(4)} {r.randrange(99)}</p></div>", f"<p>{phrase(1)}</p>"]) for _ in range(r.randrange(1, 9)))
        rows.append((n, f"http://{host}/{n}", f"<html><body>{own}</body></html>"))
        trees.append((host, Tree(rows[-1][2]).root))
    walk = lambda e: [repr(e), *(x for c in e[2] if isinstance(c, list) for x in walk(c))]
    pages, held = Counter(h for h, _ in trees), Counter((h, x) for h, t in trees for x in set(walk(t)))
    gone = {k for k, n in held.items() if n >= 10 or (n >= 3 and pages[k[0]] < 20 and 2 * n >= pages[k[0]])}

    def blocks(e, host):
        if isinstance(e, str):
            return [e]
        if e[0] not in ("#", "html", "body") and (host, repr(e)) in gone:
            return []
        inner = [x for c in e[2] for x in blocks(c, host)]
        return [" ".join(inner)] if e[0] in ("p", "div") and inner else inner

    out = {x["page_id"]: x["text"] for x in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    copied = {n for n, (h, t) in enumerate(trees) if (h, repr(t[2][0])) in gone or all((h, repr(c)) in gone for c in t[2][0][2][0][2]) and len(t[2][0][2][0][2]) == 1}
    assert len(gone) > 8
    for n, (h, t) in enumerate(trees):
        if n not in copied:
            assert out[n] == "\n".join(blocks(t, h)), rows[n]


@pytest.mark.parametrize(("page", "text"), [
    ("<article><!--><p>text one</p><!-- x --></article>", "text one"), ("<article><!---><p>a</p><!-- - --!><p>b</p></article>", "a\nb"), ("<p>a<!-- > -- - >x--></p>", "a"),
    ('<article><p>a</p><div class="widget">b</div><div class="notice">c</div><p id="related">d</p><div class="promotion">e</div><blockquote class="social">f</blockquote><label>g</label><div class="comments">h</div></article>', "a\nb\nc\nd\ne\nf\ng"),
    ('<div class="notice">b</div><p>a</p><form><label>g</label></form>', "a"),
])
def test_comments_and_names(page, text):
    own = html_text._Page(page)
    assert own.text(np.zeros(len(own.tags) - 1, bool)) == text


@pytest.mark.parametrize("page", ["</b>" * 60_000 + "<p>end</p>", "<b>" * 60_000 + "<p>end</p>", "<p><b>" * 30_000 + "</i>" * 30_000 + "end", "<li>x" * 30_000])
def test_stray_and_unclosed_tags_take_linear_time(page):
    began = time.time()
    html_text._Page(page)
    assert time.time() - began < 5


def test_pages_with_clashing_columns(spark):
    rows = [(n, f"http://a.b/{n}", f"<body><div><em>Box</em></div><p>Own {n}</p></body>", 1, "t", 2, "r") for n in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, row int, text string, n_chars int, __rest string")
    for small in (0, 100):
        out = html_text.main_text(df, small=small)
        assert out.columns == ["page_id", "url", "row", "__rest", "text", "n_chars"]
        assert sorted(map(tuple, out.collect())) == [(n, f"http://a.b/{n}", 1, "r", f"Own {n}", len(f"Own {n}")) for n in range(12)]


def test_query_returns_every_page(spark):
    out = queries.op2_html_extraction(spark, TINY).toPandas()
    assert len(out) == duckdb.sql(f"select count(*) from '{TINY}/pages.parquet'").fetchall()[0][0]
    assert (out["text"].str.len() == out["n_chars"]).all() and not out["text"].str.contains("<div|&amp;|\n\n|  ").any()
