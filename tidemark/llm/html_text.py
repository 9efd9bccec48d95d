"""Main text of web pages, with site templates found by counting element subtrees per host.

1. Every page is read into elements. A subtree's hash covers its tags, its
   attributes and its text; the hashes of a page are counted once per page.
2. Spark counts pages for each (host, subtree). What recurs on at least
   `min_pages` pages is template, however large the host; on a host of fewer pages
   than twice that, what at least three and at least half of its pages hold.
3. A page's text is taken from its main element that holds an article, else its
   articles, else its main element, else its body: without template subtrees, without
   elements whose tag or role, or whose whole class or id, says that they are menus, headers, footers, sidebars, notices,
   adverts, forms, reader comments or code, and without markup. Paragraphs,
   headings, lists and tables of an article stay even where they recur: articles quote
   each other and are copied, in part or whole.
   A page whose articles all recur as they are (else its main elements, else the
   smallest element around its visible text) is a copy: what recurs in them stays.

Character references are decoded; white space inside a block becomes one
space; blocks join by a newline. A null page has an empty text; a null url
is a host of its own. Repeated rows are separate pages. Columns `text` and `n_chars`
of the input give way to the result's.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm._store import bounded, kept, small_batches, small_side

MIN_PAGES = 10
#: Pages of a small host that must share a template.
LEAST_PAGES = 3
#: Small hosts up to this number are broadcast; beyond it Spark joins by shuffle.
SMALL_ROWS = 1_000_000
#: Template subtrees up to this number are broadcast (8 bytes each); beyond it pages are joined with theirs.
SMALL_TEMPLATES = 1_000_000

_TOKEN = re.compile(r"<!---?>|<!--.*?(?:--!?>|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_DROPPED = frozenset("script style noscript template head nav footer aside form iframe svg math canvas object embed audio video button select option input textarea fieldset dialog menu map".split())
_BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dd dt b i em strong a span u code q cite figcaption caption tr table tbody ul ol dl".split())
_CLOSED_BY_BLOCK = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table div section article main body html td th".split())
#: Words that name boilerplate where a class or id holds nothing else than them, numbers and words of place.
_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar rail "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar header masthead topbar footer copyright comment comments commentlist disqus respond replies share sharing social related recommended widget skip search "
    "adsbygoogle adbox adslot adunit taboola outbrain addthis sharethis addtoany sidenav sidemenu topnav subnav navmenu megamenu siteheader sitefooter cookiebar cookiebanner skiplink commentform disclaimer".split()
)
_PLACES = frozenset(
    "site page main global top bottom left right upper lower primary secondary inner outer wrapper wrap container content box block area section list item items link links bar panel row col column slot unit zone group holder "
    "post posts article articles story stories news reader readers user form button buttons btn icon icons text title message to us by with and the of for on in "
    "thread count meta author avatar body head logo sub mini sticky fixed floating mobile desktop large small wide full half new latest popular more recent tag tags category policy privacy accept close toggle dropdown open "
    "facebook twitter linkedin email google native display inline leaderboard rectangle skyscraper placeholder widget menu js".split()
)
#: Those of them that stand alone inside an article, too: for comments of readers and adverts. Others, like a notice, may be of its text.
_INSIDE = frozenset("ad ads advert adverts advertisement adsbygoogle taboola outbrain comment comments commentlist commentform disqus respond replies".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


def _boilerplate(name: str, inside: bool) -> bool:
    """Whether a class or id is made of words for boilerplate and places. `inside` an article a header holds its heading, and one word alone says so only of comments and adverts."""
    parts = [x.lower() for x in _PARTS.findall(name)]
    named = [x for x in parts if x in _NAMES]
    if inside and ("header" in named or len(parts) == 1 and parts[0] not in _INSIDE):
        return False
    return bool(named) and all(x in _NAMES or x in _PLACES or x.isdigit() for x in parts)


class _Page:
    """Elements in page order: tag, parent, attributes; and the text pieces between tags with the element they lie in."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes = ["#"], [-1], [""]
        self.pieces: list[tuple[int, str]] = []  # (element, text); a negative element ~e marks where block e begins or ends
        stack, at, n = [0], 0, len(source)
        self.open: Counter = Counter()  # by tag, so that an end tag of none that is open costs nothing
        while at < n:
            m = _TOKEN.search(source, at)
            text = source[at : m.start() if m else n]
            if text:
                self.pieces.append((stack[-1], text))
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self.pieces.append((stack[-1], html.escape(m[0][9:].removesuffix("]]>"), quote=False)))
                continue
            if m[1]:
                self._close(stack, tag)
                continue
            if tag in _CLOSED_BY_BLOCK:
                self._close_open(stack, {"p"}, _SCOPE)
            if tag in _SIBLINGS:
                self._close_open(stack, _SIBLINGS[tag], {"ul", "ol", "dl", "table", "select", "tr"} - _SIBLINGS[tag])
            e = len(self.tags)
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.attributes.append(m[3].strip())
            if tag in _BLOCKS or tag == "br":
                self.pieces.append((~e, ""))
            if tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                stop = end.start() if end else n
                self.pieces.append((e, source[at:stop]))
                close = source.find(">", stop)
                at = n if not end or close < 0 else close + 1
            elif tag not in _VOID and not m[3].endswith("/"):
                stack.append(e)
                self.open[tag] += 1
        self.kept_open = stack

    def _end(self, stack: list[int], depth: int) -> None:
        """Closes the elements from a depth on."""
        for e in stack[depth:]:
            self.open[self.tags[e]] -= 1
            if self.tags[e] in _BLOCKS:
                self.pieces.append((~e, ""))
        del stack[depth:]

    def _close(self, stack: list[int], tag: str) -> None:
        if self.open[tag]:
            self._end(stack, next(d for d in range(len(stack) - 1, 0, -1) if self.tags[stack[d]] == tag))

    def _close_open(self, stack: list[int], tags: set, scope) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[depth]]
            if tag in tags:
                return self._end(stack, depth)
            if tag in scope:
                return None

    def hashes(self, host: str) -> np.ndarray:
        """A hash of each element's subtree, and of the host."""
        held: list[list[str]] = [[] for _ in self.tags]
        for e, text in self.pieces:
            if e >= 0 and (text := " ".join(text.split())):
                held[e].append(text)
        out = np.zeros(len(self.tags), np.uint64)
        for e in range(len(self.tags) - 1, 0, -1):
            held[e].append(f"<{self.tags[e]} {self.attributes[e]}>")
            own = xxhash.xxh64_intdigest("\x00".join(held[e]))
            held[self.parents[e]].append(f"{own:x}")
            out[e] = xxhash.xxh64_intdigest(f"{host}\x00{own:x}")
        return out[1:]

    def _named(self, e: int, inside: bool) -> bool:
        for name, value in _ATTRIBUTE.findall(self.attributes[e]) if self.attributes[e] else ():
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id") and any(_boilerplate(x, inside) for x in (value.split() if name == "class" else [value])):
                return True
            if name == "role" and value.lower() in _ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        return False

    def _copied(self, template: np.ndarray, hidden: list[bool]) -> list[bool]:
        """A flag for each element in or around the content of a page that is a copy as a whole."""
        n = len(self.tags)
        copied = [False] * n
        for tag in ("article", "main"):
            roots = [e for e in range(1, n) if self.tags[e] == tag and not hidden[e]]
            if roots:
                break
        else:
            common: list[int] | None = None
            for e in {e for e, text in self.pieces if e > 0 and not hidden[e] and text.strip()}:
                path = [e]
                while path[-1]:
                    path.append(self.parents[path[-1]])
                path.reverse()
                common = path if common is None else [a for a, b in zip(common, path) if a == b]
            roots = common[-1:] if common else []
        if not roots or not all(e and template[e - 1] for e in roots):
            return copied
        for e in roots:
            copied[e] = True
        for e in range(1, n):
            copied[e] = copied[e] or (copied[self.parents[e]] and self.parents[e] > 0)
        for e in roots:
            while e := self.parents[e]:
                copied[e] = True
        return copied

    def text(self, template: np.ndarray) -> str:
        """template: a flag for each element whose subtree is the site's."""
        n = len(self.tags)
        hidden, inside = [False] * n, [False] * n  # by tag or name; inside an article or main element
        for e in range(1, n):
            p, tag = self.parents[e], self.tags[e]
            inside[e] = inside[p] or tag in ("article", "main")
            named = self._named(e, inside[p]) and (tag not in ("html", "body", "main"))
            hidden[e] = hidden[p] or tag in _DROPPED or (tag == "header" and not inside[p]) or named
        copied, gone = self._copied(template, hidden), [False] * n
        for e in range(1, n):
            p, tag = self.parents[e], self.tags[e]
            frame = tag in ("html", "body", "main", "article")
            gone[e] = hidden[e] or gone[p] or (bool(template[e - 1]) and not frame and not copied[e] and not (inside[e] and tag in _PROSE))
        articles = [e for e in range(1, n) if self.tags[e] == "article" and not gone[e]]
        around = set()  # main elements that hold an article
        for e in articles:
            while e := self.parents[e]:
                if self.tags[e] == "main":
                    around.add(e)
        wanted = around or set(articles) or {e for e in range(1, n) if self.tags[e] == "main" and not gone[e]}
        root = [not wanted] * n
        for e in range(1, n):
            root[e] = not wanted or root[self.parents[e]] or e in wanted
        blocks: list[list[str]] = [[]]
        for e, text in self.pieces:
            if e < 0:
                if self.tags[~e] == "br":
                    blocks[-1].append(" ")
                elif blocks[-1]:
                    blocks.append([])
            elif root[e] and not gone[e]:
                blocks[-1].append(text)
        return "\n".join(t for b in blocks if (t := _SPACE.sub(" ", html.unescape("".join(b))).strip()))


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _subtrees(batches):
    """(host, subtree, n): each task counts pages first, so that hot hosts come as one row a subtree."""
    pages: dict[str, int] = {}
    seen: dict[str, dict[int, int]] = {}

    def rows():
        for h, own in seen.items():
            ids, n = np.fromiter(own, np.uint64, len(own)), np.fromiter(own.values(), np.int64, len(own))
            yield pa.RecordBatch.from_arrays([pa.array([h] * (len(own) + 1)), pa.array(np.append(ids, np.uint64(0)).view(np.int64)), pa.array(np.append(n, pages.pop(h)))], names=["host", "subtree", "n"])
        seen.clear()

    held = 0
    for batch in batches:
        for url, source in zip(*(batch.column(i).to_pylist() for i in range(2))):
            h = host(url)
            own = seen.setdefault(h, {})
            pages[h] = pages.get(h, 0) + 1
            for x in set(_Page(source).hashes(h).tolist()) if source else ():
                own[x] = own.get(x, 0) + 1
                held += 1
        if held > 1_000_000:
            yield from rows()
            held = 0
    yield from rows()


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, subtree): hashes of element subtrees that recur across the pages (url, html) of a host."""
    counts = pages.select(F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(_subtrees, "host string, subtree long, n long").groupBy("host", "subtree").agg(F.sum("n").alias("n"))
    counts = kept(counts.where((F.col("n") >= min(min_pages, LEAST_PAGES)) | (F.col("subtree") == 0)))
    own = counts.where("subtree <> 0")
    small = counts.where((F.col("subtree") == 0) & (F.col("n") < 2 * min_pages)).select("host", F.col("n").alias("pages"))
    on_small = own.where(F.col("n") < min_pages).join(small_side(small, SMALL_ROWS), "host").where(2 * F.col("n") >= F.col("pages"))
    return own.where(F.col("n") >= min_pages).select("host", "subtree").union(on_small.select("host", "subtree"))


def _texts(batches, known):
    fixed = known.value if known is not None else None
    for batch in batches:
        own = batch.column(3).to_pylist() if fixed is None else None
        out = []
        for i, (url, source) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            if not source:
                out.append("")
                continue
            page = _Page(source)
            hashes = page.hashes(host(url))
            if fixed is None:
                template = np.isin(hashes, np.array(own[i] or [], np.int64).view(np.uint64))
            elif len(fixed):
                template = fixed[np.minimum(np.searchsorted(fixed, hashes), len(fixed) - 1)] == hashes
            else:
                template = np.zeros(len(hashes), bool)
            out.append(page.text(template))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["__rest", "text", "n_chars"])


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, small: int = SMALL_TEMPLATES) -> DataFrame:
    """`pages` (url, html and more; html itself left out) with `text` and `n_chars`."""
    spark = pages.sparkSession
    small_batches(spark)
    found = kept(templates(pages, min_pages))
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    given = pages.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("__rest"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    if bounded(found, small):
        sent = spark.sparkContext.broadcast(np.sort(found.select("subtree").toPandas()["subtree"].to_numpy(np.int64).view(np.uint64)))
    else:  # each host's templates go to its pages; a page is found again by its own subtrees
        sent = None
        numbered = kept(given.withColumn("row", F.monotonically_increasing_id()))
        marks = numbered.select("row", "url", "html").mapInArrow(_page_subtrees, "row long, subtree long").join(found.select("subtree"), "subtree")
        given = numbered.join(marks.groupBy("row").agg(F.collect_set("subtree").alias("known")), "row", "left").select("__rest", "url", "html", "known")
    out = given.mapInArrow(lambda it: _texts(it, sent), StructType([given.schema["__rest"], StructField("text", StringType()), StructField("n_chars", LongType())]))
    return out.select(*(F.col("__rest").getField(c).alias(c) for c in keep), "text", "n_chars")


def _page_subtrees(batches):
    for batch in batches:
        rows, ids = [], []
        for row, url, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = np.unique(_Page(source).hashes(host(url))) if source else np.zeros(0, np.uint64)
            rows += [row] * len(own)
            ids.append(own)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(flat.view(np.int64))], names=["row", "subtree"])
