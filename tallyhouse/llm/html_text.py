"""Main text of web pages by site template removal.

Each page is parsed into elements; an element's subtree gets a hash of its tags, classes and texts.  Spark counts
on how many different pages of its host each subtree occurs; subtrees that recur are the host's template and are deleted, inside
an article or main element as well as outside.  What must not go with them is running text that pages share: inside an article
or main element paragraphs, headings, items and cells are never counted, and a subtree that holds a text of `RUN_CHARS`
characters or more is none either; outside, such a subtree must recur on a share of the host's pages as well as on a number
of them.  For all others the number of pages is absolute, so furniture goes from a host of any size.

Elements whose tag, role or class says that they are no content (menus, adverts, forms, ...) go as well, because a host
with few pages shows no recurrence.  Outside an article or main element a part of a class name says so, inside one a whole
name, so that `market-share` stays.  What is left of the article that holds the most text is the text.  Several articles beside more than
twice as much text outside them are teasers; then, and without an article, the text is what lies outside, in the main element if
that has some.

The second pass parses the page again instead of shuffling it.  The template keys are broadcast if there are at most
`broadcast_keys` of them; beyond that every page gets the keys found on it by joins.  Reading a page takes time in proportion
to its length, whatever its markup.

Edge cases: null or empty html gives an empty text; a page whose url is null or has no host belongs to the empty host;
unclosed, crossed and stray tags never fail; copies of a page count once for the template; repeated rows give
repeated rows; an empty table gives an empty table; other columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.texts import whole
from tallyhouse.sources.scratch import stored

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Elements that hold no content, by tag, by role and by a word of their class or id.
FURNITURE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe svg canvas object button select textarea menu dialog "
    "title audio video".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
COMMENT_WORDS = frozenset("comment comments respond replies disqus".split())
FURNITURE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs footer cookie cookies consent gdpr notice popup modal newsletter subscribe related share sharing "
    "social widget pagination toolbar masthead".split()
)
#: An opening tag of the first kind ends an open element of the second kind.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
BOUNDS = frozenset("ul ol dl table article main section div body html".split())  # what an implied end doesn't cross
#: Elements of running text, and how long a text must be to be running text by itself.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption summary tr".split())
RUN_CHARS = 100
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())  # their content is no markup
UNESCAPED = frozenset("textarea title".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_NAME = re.compile(r"[a-zA-Z][^\t\n\r\f />\x00]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|(?!['"])[^\s>]*|['"][^>]*))?""")


class Tokens:
    """Start tags, end tags and texts of a page, each place read a bounded number of times."""

    def __init__(self, html: str):
        self.html = html
        self.gone: dict[str, int] = {}  # what does not occur from a place on

    def find(self, what: str, at: int) -> int:
        """Where something occurs from a place on, or -1; a search that failed is not made again."""
        if self.gone.get(what, len(self.html) + 1) <= at:
            return -1
        place = self.html.find(what, at)
        if place < 0:
            self.gone[what] = at
        return place

    def attributes(self, at: int) -> tuple[list[tuple[str, str | None]], int]:
        """Attributes from behind a tag's name, and the place behind the tag; -1 where the tag does not end."""
        html, found = self.html, []
        while True:
            match = _ATTRIBUTE.match(html, at)
            if match is None:
                end = self.find(">", at)
                return found, end + 1 if end >= 0 else -1
            name, value = match[1].lower(), match[2]
            if value and value[0] in "\"'":
                if len(value) < 2 or value[-1] != value[0]:  # a quote that never ends: the tag ends at the next bracket
                    end = self.find(">", match.start(2))
                    return found, end + 1 if end >= 0 else -1
                value = value[1:-1]
            found.append((name, None if value is None else unescape(value)))
            at = match.end()

    def __iter__(self) -> Iterator[tuple[str, str, list]]:
        """("start", tag, attributes), ("end", tag, []) and ("text", text, [])."""
        html, at, size = self.html, 0, len(self.html)
        while at < size:
            place = html.find("<", at)
            if place < 0:
                yield "text", unescape(html[at:]), []
                return
            if place > at:
                yield "text", unescape(html[at:place]), []
            if html.startswith("<!--", place):
                end = self.find("-->", place + 2)
                if end < 0:
                    return  # the rest of the page is a comment
                at = end + 3
            elif html[place + 1 : place + 2] in ("!", "?"):
                at = self.find(">", place) + 1 or size
            elif match := _NAME.match(html, place + 1):
                tag = match[0].lower()
                attributes, end = self.attributes(match.end())
                if end < 0:
                    return  # a tag that never ends
                yield "start", tag, attributes
                at = end
                if tag in RAW:
                    end = self._raw_end(tag, at)
                    if end > at:
                        text = html[at:end]
                        yield "text", unescape(text) if tag in UNESCAPED else text, []
                    at = end
            elif html.startswith("</", place):
                match = _NAME.match(html, place + 2)
                end = self.find(">", place)
                if match and end >= 0:
                    yield "end", match[0].lower(), []
                at = end + 1 if end >= 0 else size
            else:
                yield "text", "<", []
                at = place + 1

    def _raw_end(self, tag: str, at: int) -> int:
        """Where the end tag of raw content begins; the page's end without one."""
        place = at
        while True:
            place = self.find("</", place)
            if place < 0:
                return len(self.html)
            stop = place + 2 + len(tag)
            if self.html[place + 2 : stop].lower() == tag and self.html[stop : stop + 1] in (">", " ", "/", "\t", "\n", "\r", "\f"):
                return place
            place += 2


class Element:
    __slots__ = ("tag", "hidden", "soft", "region", "holds_main", "parts", "start", "outer", "longest")

    def __init__(self, tag: str, hidden: bool, soft: bool, region: int, parts: list, start: int, outer: Element | None):
        self.tag, self.hidden, self.soft, self.region, self.parts, self.start = tag, hidden, soft, region, parts, start
        #: The outermost hidden element around and with this one.
        self.outer = outer
        self.holds_main = False
        self.longest = 0


class Page:
    """Reads a page into blocks; `template` says whether a subtree's hash belongs to the host's template."""

    def __init__(self, template: Callable[[int], bool] | None = None):
        self.template = template
        #: Hash of each counted subtree, and whether it holds running text.
        self.subtrees: dict[int, bool] = {}
        #: The page's visible texts, the number of the article each lies in (0: none), whether in a main element or article;
        #: None parts blocks.
        self.texts: list[tuple[str | None, int, bool]] = []
        self.articles = 0
        self.open = [Element("", False, False, 0, [], 0, None)]
        #: Places of the open elements by tag, and of those that are not inline.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.article = 0

    def _end_block(self) -> None:
        if self.texts and self.texts[-1][0] is not None:
            self.texts.append((None, 0, False))

    def _furniture(self, tag: str, attrs: list, inside: int) -> tuple[bool, bool]:
        """Whether the element holds no content, and whether only its class says so (and not as comments)."""
        if tag in FURNITURE_TAGS or tag == "header" and not inside:
            return True, False
        words: set[str] = set()
        for name, value in attrs:
            if name in ("class", "id"):
                lower = (value or "").lower()
                words.update(lower.split() if inside else _SPLIT.split(lower))
            elif name == "role" and (value or "").lower() in FURNITURE_ROLES or name == "hidden":
                return True, False
        if tag in ("html", "body", "main"):
            return False, False
        if tag == "article":
            return bool(words & COMMENT_WORDS), False
        hit = words & FURNITURE_WORDS
        return bool(hit), bool(hit) and not hit & COMMENT_WORDS

    def start(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.data(" ")
            return
        above = self.open[-1]
        furniture, soft = self._furniture(tag, attrs, above.region) if attrs or tag not in INLINE else (False, False)
        if tag not in INLINE and not (tag in RAW and furniture):  # a script within a block doesn't part it
            self._imply(tag)
            self._end_block()
        if tag in VOID:
            return
        above = self.open[-1]
        region, hidden = above.region, above.hidden or furniture
        if tag in ("article", "main") and not furniture and (not above.hidden or above.soft):
            # A class such as "with-sidebar" around the article doesn't hide it.
            hidden = False
            if tag == "article" and not self.article:
                self.articles += 1
                self.article = self.articles
            region = max(region, 2 if tag == "article" else 1)
        kinds = [value or "" for name, value in attrs if name in ("class", "id")]
        soft = soft or (above.soft and not furniture)
        outer = None if not hidden else above.outer
        element = Element(tag, hidden, soft, region, [tag, *kinds], len(self.texts), outer)
        if hidden and outer is None:
            element.outer = element
        self.places.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.blocks.append(len(self.open))
        self.open.append(element)

    def _nearest(self, tags: Iterable[str]) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def _imply(self, tag: str) -> None:
        """Ends what the opening of a block element ends without saying so."""
        at = self._nearest(("p", *CLOSES.get(tag, ())))
        if at and at >= self._nearest(BOUNDS):
            self._close(at)

    def end(self, tag: str) -> None:
        raw = tag in RAW and self.open[-1].tag == tag and self.open[-1].hidden
        if tag not in INLINE and not raw:
            self._end_block()
        at = self.places[tag][-1] if self.places.get(tag) else 0
        if at and not (tag in INLINE and self.blocks and self.blocks[-1] > at):
            self._close(at)
        if tag not in INLINE and not raw:
            self._end_block()

    def _close(self, at: int) -> None:
        from xxhash import xxh64_intdigest

        while len(self.open) > at:
            element = self.open.pop()
            self.places[element.tag].pop()
            if element.tag not in INLINE:
                self.blocks.pop()
            above = self.open[-1]
            if element.region == 2 and above.region < 2:
                self.article = 0
            above.longest = max(above.longest, element.longest)
            above.holds_main |= element.holds_main or element.region > above.region
            if element.holds_main or above.hidden or element.region > above.region:
                continue  # of these, nothing is counted
            number = xxh64_intdigest("\x1f".join(element.parts).encode("utf-8", "replace"))
            above.parts.append(f"<{number:x}>")
            running = element.longest >= RUN_CHARS
            if len(element.parts) == 1 or element.region and (running or element.tag in RUNNING or element.tag in INLINE):
                continue
            self.subtrees[number] = running
            if self.template is not None and self.template(number):
                del self.texts[element.start :]
                self._end_block()

    def data(self, data: str) -> None:
        element = self.open[-1]
        if not element.holds_main and (plain := " ".join(data.split())):
            holder = element.outer or element  # what is inside furniture counts for its outermost element
            holder.parts.append(plain)
            holder.longest = max(holder.longest, len(plain))
        if not element.hidden:
            self.texts.append((data, self.article, element.region > 0))

    def finish(self, html: str) -> Page:
        for kind, value, attrs in Tokens(html):
            if kind == "text":
                self.data(value)
            elif kind == "start":
                self.start(value, attrs)
            else:
                self.end(value)
        self._close(1)
        return self

    def text(self) -> str:
        sizes = [0] * (self.articles + 1)
        for text, article, _ in self.texts:
            if text is not None:
                sizes[article] += len("".join(text.split()))
        best = max(range(1, self.articles + 1), key=lambda i: (sizes[i], -i), default=0)
        # Several articles beside more text of the page's own are teasers.
        chosen = 0 if self.articles > 1 and sizes[0] > 2 * sizes[best] else best
        only_main = not chosen and any(t and t.strip() and not article and inside for t, article, inside in self.texts)
        blocks, held = [], []
        for text, article, inside in [*self.texts, (None, 0, False)]:
            if text is not None:
                if article == chosen and (inside or not only_main):
                    held.append(text)
            elif held:
                if block := " ".join("".join(held).split()):
                    blocks.append(block)
                held = []
        return "\n".join(blocks)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def template_key(host: str, subtree: int) -> int:
    """One signed 64-bit number for a subtree of a host."""
    from xxhash import xxh64_intdigest

    return _signed(xxh64_intdigest(f"{host}\n{subtree:x}".encode("utf-8", "replace")))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh64_intdigest

    for batch in batches:
        hosts, pages, keys, runs = [], [], [], []
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            host, page = host_of(url), _signed(xxh64_intdigest(html.encode(), 42))
            found = {template_key(host, number): running for number, running in Page().finish(html).subtrees.items()}
            found[0] = True  # 0 counts the page itself
            hosts += [host] * len(found)
            pages += [page] * len(found)
            keys += found.keys()
            runs += found.values()
        arrays = [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(keys, pa.int64()), pa.array(runs, pa.bool_())]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "page", "subtree", "running"])


def _strip(known: frozenset[int] | None):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            own = batch.column(2).to_pylist() if known is None else [known] * batch.num_rows
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), own, strict=True)
            for url, html, keys in rows:
                host, keys = host_of(url), keys or ()
                texts.append(Page(lambda number: template_key(host, number) in keys).finish(html).text())  # noqa: B023
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], batch.column(0), pa.array(texts, pa.string())], names=["key", "url", "text"]
            )

    return strip


def templates(subtrees: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """`subtree` keys that occur on at least so many of their host's different pages, running texts on such a share too."""
    counts = subtrees.distinct().groupBy("host", "subtree").agg(F.count("*").alias("count"), F.max("running").alias("running"))
    pages = counts.where("subtree = 0").select("host", F.col("count").alias("pages"))
    often = counts.where((F.col("subtree") != 0) & (F.col("count") >= min_pages))
    running = often.where("running").join(pages, "host").where(F.col("count") >= F.col("pages") * min_share)
    return often.where(~F.col("running")).select("subtree").union(running.select("subtree")).distinct()


def main_text(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_pages: int = 5,
    min_share: float = 0.01,
    broadcast_keys: int = 200_000,
) -> DataFrame:
    """Key, url and `text` of every page."""
    source = pages.select(F.col(url).alias("url"), whole(html).alias("html"), F.col(key).alias("key"))
    subtrees = stored(source.select("url", "html").mapInArrow(_count, "host string, page long, subtree long, running boolean"), "subtrees")
    found = stored(templates(subtrees, min_pages, min_share), "templates")
    fields = [source.schema["key"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())]
    if found.count() <= broadcast_keys:
        keys = frozenset(row["subtree"] for row in found.collect())
        texts = source.select("url", "html", F.lit(None).cast("array<bigint>").alias("keys"), "key")
        texts = texts.mapInArrow(_strip(keys), T.StructType(fields))
    else:
        own = subtrees.join(found, "subtree", "left_semi").groupBy("page").agg(F.collect_set("subtree").alias("keys"))
        texts = source.join(own, F.xxhash64("html") == F.col("page"), "left").select("url", "html", "keys", "key")
        texts = texts.mapInArrow(_strip(None), T.StructType(fields))
    return texts.withColumnsRenamed({"key": key, "url": url})
