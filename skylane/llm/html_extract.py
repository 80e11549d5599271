"""Main text of web pages.

Pages are parsed into elements where they are read.  The first pass hashes the
subtree of every container element and counts, per host, on how many different
articles each hash stands; a subtree on many of them, and on a share of all of
the host's articles (within article elements on most), is part of the site's
template.  The second pass writes the text of the article without those
subtrees and without the elements whose tag, role or class names them as
menus, headers, footers, sidebars, notices, adverts, forms, code or comments.
Class and id name an element by whole names (``left-sidebar``, not
``has-sidebar``), never an article, and never the wrapper of the page's text.

The article is the page's ``article`` elements, else its ``main`` element,
else its body.  Paragraphs and headings are never judged by recurrence: a
sentence that many articles repeat stays, in a container of its own too unless
most of them do.  Copies of a page count as one
article, so a page's own text is never taken for a template.

Defined results: NULL or empty html gives the empty text; a page without a
host (NULL or malformed url) has no template; repeated rows each get a row; an
empty table gives no rows.  Only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skylane.llm.common import broadcast_if_small, shared_table

#: A subtree on at least this many different articles of a host, and on this
#: share of them, is template.
TEMPLATE_ARTICLES = 8
TEMPLATE_SHARE = 0.1
#: Within an article element it has to stand on this share.
ARTICLE_TEMPLATE_SHARE = 0.5
BROADCAST_ROWS = 200_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CODE = frozenset("script style textarea title xmp noembed noframes iframe".split())
SKIPPED = CODE | frozenset("noscript template svg math button select datalist object audio video canvas".split())
CONTAINERS = frozenset("article aside body details div dl fieldset figure footer form header main menu nav "
                       "ol section table ul".split())
BLOCKS = CONTAINERS | frozenset("address blockquote caption center dd dialog dt figcaption h1 h2 h3 h4 h5 h6 head "
                                "hgroup hr html legend li optgroup option p pre summary tbody td tfoot th thead tr".split())
ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
               "th": ("tr", "table"), "option": ("select",), "tbody": ("table",), "thead": ("table",)}
# What names an element that is no part of the article.
DROPPED_TAGS = frozenset("nav footer aside form head dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
DROPPED_NAMES = ("ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|nav|navbar|navigation|menu|"
                 "breadcrumbs?|sidebar|footer|masthead|comments?|commentlist|cookies?|consent|gdpr|notice|popup|modal|newsletter|"
                 "subscribe|share|sharing|social|related|widget|pagination|pager|toolbar|disqus|respond")
#: A whole class or id that has such a part, but not one that only says whether
#: there is such an element (has-sidebar, no-comments, sidebar-left-enabled).
DROPPED_TOKEN = re.compile(rf"(?:.*[-_])?(?:{DROPPED_NAMES})(?:[-_].*)?", re.S)
QUALIFIED_TOKEN = re.compile(r"(?:(?:.*[-_])?(?:has|have|no|non|not|with|without|hide|show|enable|disable)[-_].*|"
                             r".*[-_](?:enabled|disabled|open|opened|closed|active|inactive|hidden|visible))", re.S)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?/][^>]*>", re.S)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def named_as_dropped(names: str) -> bool:
    """Whether a class or id names an element that is no part of the article."""
    return any(DROPPED_TOKEN.fullmatch(n) and not QUALIFIED_TOKEN.fullmatch(n) for n in names.split())


class _Element:
    """``named``: dropped for its class or id, unless it holds the article;
    ``holds``: an article element stands in it; ``inside``: it stands in one or is one."""

    __slots__ = ("tag", "block", "hashed", "dropped", "named", "holds", "inside", "first")

    def __init__(self, tag: str, block: bool, container: bool, dropped: bool, named: bool, inside: bool, first: int):
        self.tag, self.block, self.dropped, self.named, self.inside, self.first = tag, block, dropped, named, inside, first
        self.holds = False
        self.hashed = xxhash.xxh3_64() if container else None


class Page:
    """One pass over a page's tags.

    ``blocks`` holds the text so far; an element that turns out to be dropped
    takes back what it added.  ``subtrees`` lists the container hashes
    with whether they stand within an article element,
    ``article`` the article's blocks (None when there is no such element).
    """

    def __init__(self, html: str, template: frozenset[tuple[int, bool]] | None = None):
        self.template = template or frozenset()
        self.subtrees: set[tuple[int, bool]] = set()
        self.blocks: list[str] = []
        self.line: list[str] = []
        self.open: list[_Element] = []
        # first and last block, and whether no named element is around it
        self.found: dict[str, list[tuple[int, int, bool]]] = {"article": [], "main": []}
        # named elements: first and last block, and whether they hold an article
        self.named: list[tuple[int, int, bool]] = []
        self._parse(html)

    def text(self) -> str:
        gone = self._gone()
        article, main = ([s for s in spans if s[2] or not all(gone[s[0]:s[1]])] for spans in self.found.values())
        spans = article or main or [(0, len(self.blocks), True)]
        keep, done = [], 0
        for first, last, _ in sorted(spans):
            keep += [self.blocks[i] for i in range(max(first, done), last) if not gone[i]]
            done = max(done, last)
        return " ".join(keep)

    def _gone(self) -> list[bool]:
        """Per block, whether a named element takes it away.  One that holds an
        article and most of the text, or nearly all text, on a page whose
        articles all stand in named elements, is the page's wrapper."""
        starts = [0] * (len(self.blocks) + 1)
        if self.named:
            sizes = [0, *accumulate(map(len, self.blocks))]
            outside = any(s[2] for spans in self.found.values() for s in spans)
            for first, last, holds in self.named:
                size = sizes[last] - sizes[first]
                if outside or not ((holds and 2 * size > sizes[-1]) or 10 * size > 9 * sizes[-1]):
                    starts[first] += 1
                    starts[last] -= 1
        return [n > 0 for n in accumulate(starts)]

    def _end_line(self) -> None:
        if self.line:
            words = "".join(self.line).split()
            self.line = []
            if words:
                text = " ".join(words)
                self.blocks.append(text)
                for element in reversed(self.open):
                    if element.hashed:
                        element.hashed.update(text.encode("utf-8", "surrogatepass") + b"\0")
                        break

    def _start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self._end_line()
            self._end_implied(tag)
        elif tag == "br":
            self.line.append(" ")
        if tag in VOID:
            return
        names = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in NAMES.finditer(attributes)} \
            if "=" in attributes else {}
        inside = any(e.tag in ("article", "main") for e in self.open)
        dropped = tag in DROPPED_TAGS or (tag == "header" and not inside) or names.get("role") in DROPPED_ROLES
        named = tag not in ("body", "html", "main", "article") and any(
            named_as_dropped(names[k]) for k in ("class", "id") if k in names)
        dropped = dropped or (named and inside)
        if (dropped or named) and not block:
            self._end_line()
        element = _Element(tag, block, tag in CONTAINERS, dropped, named,
                           inside or tag in ("article", "main"), len(self.blocks))
        if element.hashed:
            element.hashed.update(f"{tag} {names.get('class', '')} {names.get('id', '')}\0".encode("utf-8", "surrogatepass"))
        self.open.append(element)

    def _end_implied(self, tag: str) -> None:
        stops = ENDS_ITSELF.get(tag)
        for at in range(len(self.open) - 1, -1, -1):
            over = self.open[at].tag
            if over == "p" or (stops and (over == tag or {over, tag} in ({"td", "th"}, {"dt", "dd"}))):
                self._close(at)
                return
            if (stops and over in stops) or (over in CONTAINERS):
                return

    def _end(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self._end_line()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag == tag:
                self._close(at)
                return
            if not block and self.open[at].block:
                return

    def _close(self, at: int) -> None:
        """Close the element at that depth and all inside it."""
        if any(e.block or e.dropped or e.named for e in self.open[at:]) or not at:
            self._end_line()
        while len(self.open) > at:
            element = self.open.pop()
            subtree = None
            if element.hashed:
                digest = element.hashed.intdigest() - (1 << 63)
                subtree = (digest, element.inside)
                self.subtrees.add(subtree)
                for parent in reversed(self.open):
                    if parent.hashed:
                        parent.hashed.update(digest.to_bytes(8, "little", signed=True))
                        break
            dropped = element.dropped or subtree in self.template
            if dropped:
                del self.blocks[element.first:]
                for spans in (*self.found.values(), self.named):
                    spans[:] = [s for s in spans if s[0] < element.first]
            elif element.tag in self.found:
                around = [e for e in self.open if e.named]
                for e in around:
                    e.holds = True
                self.found[element.tag].append((element.first, len(self.blocks), not around))
            elif element.named:
                self.named.append((element.first, len(self.blocks), element.holds))

    def _parse(self, html: str) -> None:
        at = 0
        for token in iter(lambda: TOKEN.search(html, at), None):
            if token.start() > at:
                self._add(html[at:token.start()])
            at = token.end()
            tag = token[2]
            if not tag:
                continue
            tag = tag.lower()
            if token[1]:
                self._end(tag)
            elif tag in SKIPPED:
                if not token[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = end.end() if end else len(html) if tag in CODE else at
            else:
                self._start(tag, token[3])
        if at < len(html):
            self._add(html[at:])
        self._close(0)

    def _add(self, text: str) -> None:
        self.line.append(entities.unescape(text) if "&" in text else text)


def host_of(url) -> F.Column:
    """The lower-case host of a url; NULL without one."""
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def template_subtrees(pages: DataFrame, min_articles: int = TEMPLATE_ARTICLES) -> DataFrame:
    """(host, subtrees): the container subtrees (digest, inside) on at least
    ``min_articles`` different articles of the host and the share that is asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for host, html in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                page = Page(html or "")
                article = xxhash.xxh3_64_intdigest(page.text().encode("utf-8", "surrogatepass")) - (1 << 63)
                rows.add((host, None, None, article))
                rows.update((host, *subtree, article) for subtree in page.subtrees)
            host, digest, inside, article = zip(*rows) if rows else ((), (), (), ())
            yield pa.record_batch([pa.array(host, pa.string()), pa.array(digest, pa.int64()), pa.array(inside, pa.bool_()),
                                   pa.array(article, pa.int64())], ["host", "digest", "inside", "article"])
    seen = pages.select(host_of(F.col("url")).alias("host"), "html").where("host IS NOT NULL") \
        .mapInArrow(run, "host string, digest long, inside boolean, article long")
    # first by article, so that a hot host's counts are spread and pre-summed
    counted = shared_table(
        seen.groupBy("host", "digest", "inside", "article").agg(F.lit(1).alias("one"))
        .groupBy("host", "digest", "inside").agg(F.count("*").alias("articles"))
        .where(F.col("articles") >= min_articles), "subtrees")
    # the row without a digest counts the host's articles
    hosts = counted.where("digest IS NULL").select("host", F.col("articles").alias("of"))
    share = F.when(F.col("inside"), ARTICLE_TEMPLATE_SHARE).otherwise(TEMPLATE_SHARE)
    return counted.where("digest IS NOT NULL").join(broadcast_if_small(hosts, BROADCAST_ROWS), "host") \
        .where(F.col("articles") >= share * F.col("of")) \
        .groupBy("host").agg(F.collect_set(F.struct("digest", "inside")).alias("subtrees"))


def extract_text(pages: DataFrame, min_articles: int = TEMPLATE_ARTICLES) -> DataFrame:
    """Per page: page_id, url, text."""
    templates = shared_table(template_subtrees(pages, min_articles), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[tuple, frozenset] = {}
            texts = []
            for html, subtrees in zip(batch["html"].to_pylist(), batch["subtrees"].to_pylist()):
                key = tuple((s["digest"], s["inside"]) for s in subtrees or ())
                if key not in sets:
                    sets[key] = frozenset(key)
                texts.append(Page(html or "", sets[key]).text())
            yield pa.record_batch([batch["page_id"], batch["url"], pa.array(texts, pa.string())],
                                  ["page_id", "url", "text"])
    known = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    kinds = dict(known.dtypes)
    return known.join(broadcast_if_small(templates, BROADCAST_ROWS), "host", "left") \
        .select("page_id", "url", "html", "subtrees") \
        .mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string")


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from skylane.llm.common import read_table
    return extract_text(read_table(spark, sf_dir, "pages")) \
        .withColumn("n_chars", F.char_length("text").cast("long"))
