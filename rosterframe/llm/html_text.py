"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive and tags negative; the
contiguous run with the greatest sum, found by one linear scan, is the content region
(Pasternack and Roth, "Extracting Article Text from the Web with Maximum Subsequence
Segmentation", 2009).  The weights come from labelled pages, that is pages whose article
text is known: how often each tag, and words in running text, links and page furniture,
lie inside and outside of the article, and the price of a tag that fits these pages best.

The region then settles on the landmark (article, main), else the block, that holds nearly all
of its words, and furniture inside of it is taken out: elements whose tag,
class, id or role says that they are menus, headers, footers, sidebars, notices, adverts,
forms or reader comments.  Within a landmark, or on a page without any, a word in a class
or id is not enough: the whole name must say it, or most of the element's words be links.
"""

from __future__ import annotations

import html
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterframe.llm.common import materialize

# HTML element names by role, and the words that name page furniture.
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math object".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
IMPLIED_END = set("p li dt dd tr td th option".split())
LANDMARKS = {"article", "main"}
FURNITURE_TAGS = set("nav footer aside form header menu dialog button select fieldset datalist head".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu menus modal nav navbar navigation navi "
    "newsletter notice notices notification overlay pager pagination paywall popup promo promotion promotions recommend recommended "
    "related reply replies respond search share sharing sidebar sidebars signin signup skip social sponsor sponsored subscribe "
    "subscription teaser toolbar topbar widget widgets".split())
#: Words that may stand beside one of them in a name without changing what it names.
NEUTRAL_WORDS = set(
    "area articles bar block body bottom box button buttons container content dfp entry form global google group holder icon icons inner "
    "item items label left link links list main message module outer page panel post posts primary right secondary section site slot "
    "story text thread title toggle top unit wrap wrapper x".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTENT_WORDS = set("article content entry main post story".split())
CONTAINERS = {"article", "main", "section", "div", "td"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Every element named above and those that merely hold text: the tags that have a weight of their own.
KNOWN = RAW | VOID | INLINE | IMPLIED_END | LANDMARKS | FURNITURE_TAGS | HEADINGS | CONTAINERS | set(
    "html body address blockquote caption center col colgroup dir dl details fieldset figcaption figure hgroup legend ol optgroup output pre "
    "rp rt ruby summary table tbody tfoot thead ul audio video canvas picture map".split())
#: All the others.
OTHER_TAG = "?"
TEXT, OPEN, CLOSE = 0, 1, 2
#: Contexts of words: running text, link text, furniture.
PLAIN, LINK, OTHER = "plain", "link", "other"


class Page:
    """Tokens of a page with, for each, its context and the extent of its element.

    About 40 bytes a token: tag names are shared strings, texts and attributes are places in
    the source, everything else is a number in an array."""

    def __init__(self, source: str):
        self.source = source
        self.kind, self.value = bytearray(), []
        self._at = array("i"), array("i")
        at, names = 0, {}
        while (m := _TOKEN.match(source, at)) is not None and m.end() > at:
            at = m.end()
            if m["text"] is not None:
                self._add(TEXT, "", *m.span("text"))
                continue
            group = "" if m["tag"] else "2"
            tag = m["tag" + group]
            if tag:
                tag, close = tag.lower(), bool(m["end" + group])
                tag = names.setdefault(tag, tag)
                self._add(CLOSE if close else OPEN, tag, *((0, 0) if close else m.span("attrs" + group)))
                if tag in RAW and not close and not source.endswith("/", *m.span("attrs" + group)):
                    stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = stop.end() if stop else len(source)
                    self._add(CLOSE, tag, 0, 0)
        n = len(self.kind)
        self.words = array("i", (len(self.text(i).split()) if k == TEXT else 0 for i, k in enumerate(self.kind)))
        self.before = array("i", accumulate(self.words, initial=0))
        self.opens: dict[str, array] = {}
        for i, (k, v) in enumerate(zip(self.kind, self.value)):
            if k == OPEN:
                self.opens.setdefault(v, array("i")).append(i)
        self.end = self._ends(n)
        self.link = self._covered(n, self.opens.get("a", ()))
        self.linked = array("i", accumulate((x if f else 0 for x, f in zip(self.words, self.link)), initial=0))
        self.furniture = self._furniture(n)
        self.own_before = array("i", accumulate((0 if f else x for x, f in zip(self.words, self.furniture)), initial=0))
        self.own_linked = array("i", accumulate((x if a and not f else 0 for x, a, f in zip(self.words, self.link, self.furniture)), initial=0))

    def _add(self, kind: int, value: str, first: int, last: int) -> None:
        self.kind.append(kind)
        self.value.append(value)
        self._at[0].append(first)
        self._at[1].append(last)

    def text(self, i: int) -> str:
        """The characters of a text, the attributes of a start tag."""
        return self.source[self._at[0][i]:self._at[1][i]]

    def _ends(self, n: int) -> list[int]:
        """For each start tag the token after its element.  One that is never closed ends with
        the next block (paragraphs, links and the like), else before the next landmark."""
        end, opened = array("i", bytes(4 * n)), {}
        for i, (k, v) in enumerate(zip(self.kind, self.value)):
            if k == OPEN:
                if v in VOID:
                    end[i] = i + 1
                else:
                    opened.setdefault(v, []).append(i)
            elif k == CLOSE and opened.get(v):
                end[opened[v].pop()] = i + 1
        block = landmark = n
        for i in range(n - 1, -1, -1):
            k, v = self.kind[i], self.value[i]
            if k == OPEN and not end[i]:
                end[i] = block if v in IMPLIED_END or v in INLINE else landmark
            if k != TEXT and v not in INLINE:
                block = i
                if k == OPEN and v in LANDMARKS:
                    landmark = i
        return end

    def _covered(self, n: int, starts: Iterable[int]) -> bytearray:
        edge = array("i", bytes(4 * (n + 1)))
        for i in starts:
            edge[i] += 1
            edge[max(self.end[i], i + 1)] -= 1
        return bytearray(x > 0 for x in accumulate(islice(edge, n)))

    def _attributes(self, i: int) -> dict[str, str]:
        return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(self.text(i))}

    def _named(self, a: dict[str, str]) -> set[str]:
        return {p.lower() for p in _NAME_PART.findall(f"{a.get('class', '')} {a.get('id', '')}")}

    def _holds(self, i: int, tags: set[str]) -> bool:
        return any(bisect_left(at, self.end[i]) > bisect_right(at, i) for t in tags if (at := self.opens.get(t)))

    def _surely_named(self, i: int, a: dict[str, str]) -> bool:
        """Whether a whole class or id, not just a word in it, names furniture.  Ids of headings are made of
        their text, and a header that holds or is a headline belongs to the article."""
        heading = self.value[i] in HEADINGS
        headline = heading or self._holds(i, {"h1", "h2"})
        for name in [*a.get("class", "").split(), *([] if heading else a.get("id", "").split())]:
            parts = {p.lower() for p in _NAME_PART.findall(name) if not p.isdigit()}
            if parts & FURNITURE_WORDS - ({"header", "banner"} if headline else set()) and parts <= FURNITURE_WORDS | NEUTRAL_WORDS:
                return True
        return False

    def _furniture(self, n: int) -> bytearray:
        article = self._covered(n, (i for t in LANDMARKS for i in self.opens.get(t, ())))
        half = self.before[n] / 2
        linked, landmarks = self.linked, any(article)
        found = array("i")
        for i, (k, v) in enumerate(zip(self.kind, self.value)):
            if k != OPEN or v in ("html", "body"):
                continue
            if v in FURNITURE_TAGS or v in RAW:
                # an article's own header is its headline; a form or header may wrap the whole page
                if v == "header" and article[i] and self._holds(i, {"h1", "h2"}) or v in ("form", "header") and self._holds(i, LANDMARKS):
                    continue
                found.append(i)
            elif self._at[0][i] < self._at[1][i] and v != "main":
                a = self._attributes(i)
                hidden = ("hidden" in a or a.get("aria-hidden") == "true"
                          or re.search(r"display\s*:\s*none", a.get("style", "")) is not None)
                named = self._named({"class": a.get("class", "")} if v in HEADINGS else a)
                if named & FURNITURE_WORDS and (article[i] or not landmarks):  # may be text: the name alone must say it, or links
                    end = self.end[i]
                    if not (self._surely_named(i, a) or 2 * (linked[end] - linked[i]) > self.before[end] - self.before[i]):
                        named -= FURNITURE_WORDS
                if hidden or a.get("role", "").lower() in FURNITURE_ROLES or named & FURNITURE_WORDS:
                    holds_most = self.before[self.end[i]] - self.before[i] > half
                    if hidden or not (holds_most or self._holds(i, {"main"}) or v == "article" and named & CONTENT_WORDS and "comment" not in named):
                        found.append(i)
        return self._covered(n, found)

    def context(self, i: int) -> str:
        return OTHER if self.furniture[i] else LINK if self.link[i] else PLAIN

    def blocks(self, start: int, end: int) -> list[tuple[int, int, str]]:
        """(first token, token after, text) of the blocks in a range, furniture left out."""
        out, parts, first = [], [], start

        def flush(at: int) -> None:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((first, at, text))
            parts.clear()

        for i in range(start, end):
            if self.kind[i] == TEXT:
                if not self.furniture[i]:
                    if not parts:
                        first = i
                    parts.append(self.text(i))
            elif self.value[i] not in INLINE:
                flush(i)
        flush(end)
        return out


# ----------------------------------------------------------------- weights

def feature_counts(page: Page, article: str) -> Counter:
    """(feature, inside) -> count, for a page whose article has the lines ``article``;
    nothing if none of them is found."""
    lines = {" ".join(x.split()) for x in article.split("\n")} - {""}
    own = [(s, e) for s, e, text in page.blocks(0, len(page.kind)) if text in lines]
    out: Counter = Counter()
    if own:
        start, end = own[0][0], own[-1][1]
        for i, (k, v) in enumerate(zip(page.kind, page.value)):
            inside = start <= i < end
            if k == TEXT:
                out[page.context(i), inside] += page.words[i]
            else:
                out["<" + (v if v in KNOWN else OTHER_TAG), inside] += 1
    return out


#: Prices tried for a tag, in words; 3.25 is the one of the paper.
PRICES = [0.25, 0.5, 1.0, 2.0, 3.25, 5.0, 8.0]


def weights(counts: dict[tuple[str, bool], int], price: float) -> dict[str, float]:
    """Score of a word by context and of a tag by name (default: ``<``).  Words in running
    text score above 0, all tags below; the more a tag stands outside, the more it costs.  A
    tag that no labelled article holds has the default price: nothing is known of it there."""
    def share(f: str) -> float:
        i, o = counts.get((f, True), 0), counts.get((f, False), 0)
        return (i + 1) / (i + o + 2)

    w = {f: -price * (1.1 - share(f)) for f, inside in counts if f[0] == "<" and inside} | {"<": -price / 2}
    return w | {PLAIN: max(0.1, 2 * share(PLAIN) - 1), LINK: min(0.0, 2 * share(LINK) - 1), OTHER: min(0.0, 2 * share(OTHER) - 1)}


#: Without labelled pages: the published price, no learned shares.
DEFAULT = weights({(PLAIN, True): 98, (LINK, False): 98, (OTHER, False): 98}, 3.25)


# ------------------------------------------------------------------ region

def best_region(page: Page, w: dict[str, float]) -> tuple[int, int]:
    """The token range with the greatest score, by one linear scan; (0, 0) if none is positive."""
    best, run, start, region = 0.0, 0.0, 0, (0, 0)
    other = w.get("<" + OTHER_TAG, w["<"])
    price = {v: w.get("<" + v, w["<"] if v in KNOWN else other) for v in set(page.value)}
    for i, (k, v) in enumerate(zip(page.kind, page.value)):
        if run <= 0:
            run, start = 0.0, i
        run += page.words[i] * w[page.context(i)] if k == TEXT else price[v]
        if run > best:
            best, region = run, (start, i + 1)
    return region


def settle(page: Page, start: int, end: int) -> tuple[int, int, bool]:
    """(first token, token after, whether the page says so) of the article around the region.

    1. The outermost landmark (article, main) that holds nearly all of the region's words, with
       the articles next to it, between which nothing but furniture stands.
    2. Else the smallest block named as content that does, and of the blocks named so
       around it what the region reaches.
    3. Else the smallest block that does and holds most of the page's running text, so that a
       headline, a list or a table beside the region is not lost; at last the page."""
    def words(a: int, b: int) -> int:
        return page.own_before[b] - page.own_before[a]

    def holds(i: int, j: int) -> bool:
        return i < end and j > start and words(max(i, start), min(j, end)) >= 0.9 * words(start, end)

    outer: list[tuple[int, int]] = []
    for i in sorted(i for t in LANDMARKS for i in page.opens.get(t, ())):
        if not page.furniture[i] and (not outer or i >= outer[-1][1]):
            outer.append((i, page.end[i]))
    groups: list[tuple[int, int]] = []
    for i, j in outer:
        if groups and not words(groups[-1][1], i):
            groups[-1] = (groups[-1][0], j)
        else:
            groups.append((i, j))
    best = [g for g in groups if holds(*g)]
    if best:
        return *best[0], True
    boxes = sorted((page.end[i] - i, i, page.end[i]) for t in CONTAINERS - LANDMARKS for i in page.opens.get(t, ())
                   if not page.furniture[i] and holds(i, page.end[i]))
    named = [(i, j) for _, i, j in boxes if page._named(page._attributes(i)) & CONTENT_WORDS]
    if named:
        i, j = named[0]
        for a, b in named[1:]:
            if a <= i and b >= j:
                i, j = min(i, max(a, start)), max(j, min(b, end))
        return i, j, True
    n = len(page.kind)

    def plain(a: int, b: int) -> int:
        return words(a, b) - page.own_linked[b] + page.own_linked[a]

    for _, i, j in boxes:
        if 2 * plain(i, j) > plain(0, n):
            return i, j, False
    return 0, n, False


def main_text(source: str | None, w: dict[str, float]) -> str:
    if not source:
        return ""
    page = Page(source)
    start, end = best_region(page, w)
    if start == end:
        return ""
    first, last, sure = settle(page, start, end)
    found = page.blocks(first, last)
    if not sure:  # beside the region, blocks that are mostly links are menus
        found = [(a, b, t) for a, b, t in found if a < end and b > start or 2 * (page.own_linked[b] - page.own_linked[a]) <= page.own_before[b] - page.own_before[a]]
    return "\n".join(t for _, _, t in found)


# --------------------------------------------------------------- operators

def fit(labelled: DataFrame) -> dict[str, float]:
    """Weights from rows (html, article).  Counts and the fit of each price are summed on
    Spark; two numbers a tag come to the driver, so names that aren't HTML's count as one."""
    counted = labelled.mapInPandas(_count, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    counts = {(r.feature, r.inside): r.n for r in counted.where("n > 0").collect()}
    if not any(inside for _, inside in counts):
        return DEFAULT
    tried = [weights(counts, p) for p in PRICES]

    def overlap(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            score = [0.0] * len(tried)
            for source, article in zip(part["html"], part["article"]):
                page, want = Page(source or ""), Counter((article or "").split())
                for k, w in enumerate(tried):
                    region = best_region(page, w)
                    got = Counter(x for _, _, text in page.blocks(*region) for x in text.split())
                    score[k] += 2 * (got & want).total() / max(1, got.total() + want.total())
            yield pd.DataFrame({"price": range(len(tried)), "score": score})

    scores = labelled.mapInPandas(overlap, "price int, score double").groupBy("price").agg(F.round(F.sum("score"), 6).alias("score"))
    best = max(scores.collect(), key=lambda r: (r.score, -r.price))
    return tried[best.price]


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        c: Counter = Counter()
        for source, article in zip(part["html"], part["article"]):
            c.update(feature_counts(Page(source or ""), article or ""))
        yield pd.DataFrame([(f, i, n) for (f, i), n in c.items()], columns=["feature", "inside", "n"])


def labelled_sample(pages: DataFrame, documents: DataFrame, doc_of: Column, fit_pages: int = 2000) -> DataFrame:
    """(html, article) of about ``fit_pages`` pages (all, if there are fewer) whose article is a known
    document; ``doc_of`` gives a page's doc_id.  The sample is the pages whose id hashes below
    a threshold: no page is sorted or gathered.  Its bound is what makes the weights cheap
    to learn at any size, and what bounds the only thing that is broadcast, its ids."""
    below = int(min(1.0, fit_pages / max(1, pages.count())) * (1 << 31))
    chosen = (pages.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 31)) < below)
              .select("html", doc_of.cast("long").alias("known_id")).where("known_id is not null and html is not null"))
    chosen = materialize(chosen, "chosen_pages")
    texts = documents.select(F.col("doc_id").cast("long").alias("known_id"), F.col("text").alias("article")).where("article is not null")
    known = texts.join(F.broadcast(chosen.select("known_id").distinct()), "known_id", "left_semi")
    return materialize(chosen.join(known, "known_id").select("html", "article"), "labelled_pages")


#: Characters of results that a worker holds before it hands them on.
YIELD = 1 << 21


def extract(pages: DataFrame, w: dict[str, float], html_col: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``pages`` (default: all but ``html_col``) plus ``text``, the main text of each page, and
    ``n_chars``, its code points.

    - Null, empty or tag-only html: empty text.  Text without any tag is its own main text.
    - Unclosed, crossed and cut-off tags are allowed; very long pages are read whole.
    - Repeated rows are read alike; null ids and urls pass through.  Empty table: no rows.
    - An input column named text or n_chars is replaced; no other name can clash.
    """
    names = [c for c in (columns or pages.columns) if c.lower() not in ("text", "n_chars", html_col.lower())]
    src = pages.select(F.struct(*([pages[c] for c in names] or [F.lit(1)])).alias("row"), pages[html_col].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, size, texts = 0, 0, []
            for i, x in enumerate(b.column(1), 1):
                texts.append(main_text(x.as_py(), w))
                size += len(texts[-1])
                if size >= YIELD or i == b.num_rows:  # results leave the worker before they pile up
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(first, i - first), pa.array(texts, pa.string())], ["row", "text"])
                    first, size, texts = i, 0, []

    out = src.mapInArrow(run, T.StructType([src.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(*(F.col("row")[c].alias(c) for c in names), "text", F.length("text").cast("long").alias("n_chars"))
