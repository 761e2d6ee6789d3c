"""Main-text extraction with a site style tree.

The pages of one host are merged into a tree: a node is an element's path of tags, classes and
ids, and holds how its pages fill it. Two entropies say how much a node matters. *Content*: a
text block that recurs evenly over the node's pages carries nothing; one that a single page has
carries all. *Presentation*: a node whose children always look alike carries nothing.
A branch's importance is the mean over the text blocks below it, mixed with the presentation of its top
node. Each page is then read again without its host's low-importance branches.

The tree never gets to one place: nodes are rows keyed by (host, path), entropies are sums that
are built up before the shuffle, so a host with a third of all pages is like any other.

Elements that say what they are (``nav``, ``footer``, ``class="ad"`` ...) go whatever their
entropy, but a wrapper that holds most of a page's text is not judged by a word of its class.
``article`` and ``main`` say that they are content: entropy decides for the rest, also for wrappers
inside them (``div``, ``ul`` ...), but not for the article's own headings and paragraphs, and an
article that many pages of a site repeat as a whole is kept. Equal pages of a host are one page of
the tree, so mirrors don't make a text look like a template, and no page loses all of its text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

# Weight of the content below a node against its own presentation.
CONTENT_WEIGHT = 0.9
# Branches below this importance go, if at least so many pages of the host have them.
LEAST_IMPORTANCE = 0.3
LEAST_PAGES = 4
# Low branches are broadcast up to this size, joined by host beyond it.
BROADCAST_BYTES = 32 << 20
# Deeper elements count as part of the element at this depth.
DEPTH = 64

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr nobr img".split()
)
CHROME = frozenset(
    "nav header footer aside form script style noscript template iframe button select option"
    " textarea input svg canvas object embed video audio dialog menu head title".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar"
    " form".split()
)
# Words in a class or id that name what is not the article.
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar footer masthead"
    " comment comments respond disqus cookie cookies consent gdpr notice notices alert popup modal"
    " newsletter subscribe signup widget share sharing social related".split()
)
# Elements that may be furniture inside an article.
WRAPPERS = frozenset(
    "div section ul ol dl table aside nav header footer form figure fieldset details center"
    " iframe menu".split()
)
SITE = frozenset(["site", "page", "top", "global", "main"])
MAIN = {"main": 1, "article": 2}
# How sure an element's marks are that it isn't the article: the share of the page's text above
# which they don't count. A form, and a class that merely holds one of the words, may be a wrapper of
# the page ("has-sidebar"); so may, less likely, one that begins with it ("sidebar-left"). What is named
# by just the word goes, unless the page has no other text; what its tag or role says always does.
HOLDS, BEGINS, NAMED, SURE = 0.5, 0.9, 1.0, 2.0
# Start tags that end an open paragraph or an open element of their own kind.
SAME = frozenset("li dt dd option tr td th p".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
PARTS = re.compile(r"[a-z]+")

NODES = (
    "host string, path long, kind int, feature long, n long, n_log_n double,"
    " above array<bigint>, content boolean"
)


class Element:
    """An element: ``chrome`` says that it or one above it isn't the article, ``inner`` the same
    from the innermost article or main element on, ``sure`` the same by tags and roles alone.
    ``size`` is the length of its text outside of sure ones."""

    __slots__ = (
        "tag", "path", "above", "parent", "mark", "sure", "content", "children", "size", "chrome", "inner"
    )

    def __init__(self, tag, path, above, parent, mark, content):
        self.tag, self.path, self.above = tag, path, above
        self.parent, self.mark, self.content, self.children = parent, mark, content, []
        self.sure = mark >= SURE or (parent is not None and parent.sure)
        self.size, self.chrome, self.inner = 0, False, False


    def is_low(self, low: frozenset[int]) -> bool:
        """Whether it stands in a low branch. Inside an article only wrappers are branches to remove."""
        if not low.intersection(self.above):
            return False
        at = self
        while at.parent is not None:
            if at.path in low and (not at.content or at.tag in WRAPPERS):
                return True
            at = at.parent
        return False


def _marks(tag: str, rest: str) -> tuple[str, float]:
    """The element's name in the tree, and how sure it says that it isn't the article (0: not at all)."""
    mark = 0.0
    if tag in CHROME:
        mark = HOLDS if tag == "form" else SURE
    if not rest.strip(" /\n\t\r"):
        return tag, mark
    name = [tag]
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden":
            mark = SURE
        elif key == "role" and value in ROLES:
            mark = max(mark, HOLDS if value == "form" else SURE)
        elif key in ("class", "id"):
            words = PARTS.findall(value)
            name += words
            if tag in ("html", "body"):  # these tell what the page has
                continue
            if WORDS.intersection(words):
                for one in value.split():
                    parts = PARTS.findall(one)
                    if WORDS.intersection(parts):
                        sure = NAMED if len(parts) == 1 else BEGINS if parts[0] in WORDS else HOLDS
                        mark = max(mark, sure)
            if "header" in words and (len(words) == 1 or SITE.intersection(words)):
                mark = max(mark, NAMED)
    return ".".join(name), mark


class Page:
    """A page's text blocks and the tree nodes it has.

    Blocks are (text, element). Markup errors are mended as browsers do
    in the common cases: unclosed paragraphs and items, stray end tags, unclosed comments.
    """

    def __init__(self, source: str):
        root = Element("", 0, (), None, 0.0, 0)
        self.blocks: list[tuple[str, Element]] = []
        self.elements = [root]
        stack, inline, buffer = [root], [], []
        at, end = 0, len(source)

        def flush() -> None:
            if buffer:
                text = " ".join("".join(buffer).split())
                if text:
                    self.blocks.append((text, stack[-1]))
                buffer.clear()

        def say(text: str) -> None:
            if text:
                buffer.append(entities.unescape(text) if "&" in text else text)

        match = TAG.search(source)
        while match:
            say(source[at : match.start()])
            at, name = match.end(), match[2]
            if name:
                tag = name.lower()
                if tag == "br":
                    buffer.append(" ")
                elif match[1]:
                    if tag not in INLINE:
                        flush()
                    if any(e.tag == tag for e in stack):
                        flush()
                        while stack.pop().tag != tag:
                            pass
                elif tag in INLINE and not (match[3] and _marks(tag, match[3])[1]):
                    pass
                else:
                    flush()
                    if tag not in INLINE:
                        self._end_implied(stack, tag)
                    here = stack[-1]
                    label, mark = _marks(tag, match[3])
                    if len(stack) < DEPTH:
                        path = xxhash.xxh64_intdigest(f"{here.path} {label}") - (1 << 63)
                    else:
                        path = here.path
                    new = Element(
                        tag,
                        path,
                        (*here.above, path) if path != here.path else here.above,
                        here,
                        mark,
                        max(here.content, MAIN.get(tag, 0)),
                    )
                    here.children.append(label)
                    self.elements.append(new)
                    if tag in RAW:
                        close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                        if not new.sure:
                            stack.append(new)
                            say(source[at : close.start() if close else end])
                            flush()
                            stack.pop()
                        at = close.end() if close else end
                    elif tag not in VOID and not match[3].endswith("/"):
                        stack.append(new)
            match = TAG.search(source, at)
        say(source[at:])
        flush()
        self._judge()

    def _judge(self) -> None:
        """Mark what isn't the article, from the shares of the page's text."""
        for text, element in self.blocks:
            if not element.sure:
                element.size += len(text)
        for element in reversed(self.elements[1:]):
            element.parent.size += element.size
        total = self.elements[0].size
        for element in self.elements[1:]:
            above = element.parent
            own = element.mark > 0 and element.size <= element.mark * total
            element.chrome = own or above.chrome
            element.inner = own or (above.inner and element.tag not in MAIN)

    @staticmethod
    def _end_implied(stack: list[Element], tag: str) -> None:
        """A block ends an open paragraph; an item ends the item before it."""
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = stack[depth].tag
            if open_tag == "p" or (tag in SAME and open_tag == tag):
                del stack[depth:]
                return
            if open_tag not in INLINE:
                return

    def text(self, low: frozenset[int] = frozenset()) -> str:
        """Blocks of the article, or else of what no rule takes away, without low branches.

        Articles in what is not the article (comments, teasers) count only if the page has no other text.
        """
        kept = [(t, e) for t, e in self.blocks if not e.chrome]
        if not kept:  # what stands around the article is named or closed wrongly
            kept = [(t, e) for t, e in self.blocks if e.content and not e.inner]
        if not kept:
            kept = [(t, e) for t, e in self.blocks if not e.sure]
        level = max((e.content for _, e in kept), default=0)
        inside = [(t, e) for t, e in kept if e.content == level]
        high = [t for t, e in inside if not e.is_low(low)]
        if not high:  # a text that other pages repeat
            high = [t for t, _ in inside]
        return " ".join(high)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a batch's pages: text blocks (0) and child lists (1) of nodes, and the nodes (2)."""
    for batch in batches:
        total, nodes = {}, {}
        for host, source in zip(batch.column(0), batch.column(1), strict=True):
            if not (source := source.as_py()):
                continue
            host, page = host.as_py(), Page(source)
            seen = Counter()
            for text, element in page.blocks:
                feature = xxhash.xxh64_intdigest(text) - (1 << 63)
                seen[element.path, 0, feature] += 1
            held: dict[int, bool] = {}
            for element in page.elements[1:]:
                style = xxhash.xxh64_intdigest(" ".join(element.children)) - (1 << 63)
                if element.children:
                    seen[element.path, 1, style] += 1
                nodes.setdefault((host, element.path), [element.above, False, 0])
                held[element.path] = False
                if element.tag in MAIN or element.tag in ("html", "body"):
                    for path in element.above:
                        held[path] = True
            for path, content in held.items():
                node = nodes.get((host, path))
                if node:
                    node[1] |= content
                    node[2] += 1
            for key, n in seen.items():
                sums = total.setdefault((host, *key), [0, 0.0])
                sums[0] += n
                sums[1] += n * math.log(n)
        rows = [(*key, n, s, None, None) for key, (n, s) in total.items()]
        rows += [(h, p, 2, 0, n, 0.0, list(a), c) for (h, p), (a, c, n) in nodes.items()]
        if rows:
            kinds = [
                pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(),
                pa.list_(pa.int64()), pa.bool_(),
            ]
            names = ["host", "path", "kind", "feature", "n", "n_log_n", "above", "content"]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )


def style_tree(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """The merged trees of pages with (host, html): a row per branch.

    The columns are host, path, above (the paths from the top to the branch), pages, content (it
    holds or is an article somewhere; branches inside one are like any other) and importance from
    0 to 1.
    """
    raw = scratch(pages.select("host", "html").mapInArrow(_nodes, NODES))
    keys = ["host", "path"]
    node = (
        raw.filter("kind = 2")
        .groupBy(*keys)
        .agg(F.sum("n").alias("pages"), F.max("content").alias("content"), F.max("above").alias("above"))
    )
    sums = (
        raw.filter("kind < 2")
        .groupBy(*keys, "kind", "feature")
        .agg(F.sum("n").alias("n"), F.sum("n_log_n").alias("s"))
        .groupBy(*keys)
        .agg(
            # Text: per block, the entropy of the pages it stands on.
            F.sum(F.expr("IF(kind = 0, ln(n) - s / n, 0D)")).alias("spread"),
            F.sum(F.expr("IF(kind = 0, 1L, 0L)")).alias("blocks"),
            # Child lists: the entropy of the node's styles.
            F.sum(F.expr("IF(kind = 1, n, 0L)")).alias("styled"),
            F.sum(F.expr("IF(kind = 1, n * ln(n), 0D)")).alias("style_sum"),
        )
    )
    node = scratch(node.join(sums, keys, "left").na.fill(0))
    base = F.log(F.greatest("pages", F.lit(2)).cast("double"))
    below = (
        node.filter("blocks > 0")
        .select(
            "host",
            F.explode("above").alias("path"),
            "blocks",
            (F.col("spread") / base).alias("spread"),
        )
        .groupBy(*keys)
        .agg(F.sum("blocks").alias("all_blocks"), F.sum("spread").alias("all_spread"))
    )
    style = F.expr("IF(styled > 0, ln(styled) - style_sum / styled, 0D)") / base
    content = F.expr("1 - all_spread / all_blocks")
    mixed = F.lit(CONTENT_WEIGHT) * content + F.lit(1 - CONTENT_WEIGHT) * style
    importance = (
        F.when((F.col("pages") < 2) | F.col("all_blocks").isNull(), 1.0)
        .when(F.col("styled") == 0, content)
        .otherwise(mixed)
    )
    return node.join(below, keys, "left").select(
        *keys, "above", "pages", "content", importance.alias("importance")
    )


def low_branches(tree: DataFrame) -> DataFrame:
    """Per host the branches to remove: (host, low array<long>)."""
    low = tree.filter(
        (F.col("pages") >= LEAST_PAGES)
        & (F.col("importance") < LEAST_IMPORTANCE)
        & ~F.coalesce("content", F.lit(False))
    )
    return low.groupBy("host").agg(F.collect_list("path").alias("low"))


def _side(table: DataFrame, size: Column) -> DataFrame:
    """The side of a join to be broadcast if its ``size`` in bytes is small, else joined by a shuffle."""
    total = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_BYTES else table


def distinct_pages(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Pages (page_id, host, html) without those that repeat another page of their host.

    The one with the least page_id stays. Without an id, all of them do.
    """
    keyed = pages.select("page_id", "host", "html", F.xxhash64("html").alias("_digest"))
    again = scratch(
        keyed.groupBy("host", "_digest")
        .agg(F.count("*").alias("_n"), F.min("page_id").alias("_first"))
        .filter("_n > 1")
    )
    side = _side(again, F.length("host") + 24)
    found = keyed.join(side, ["host", "_digest"], "left")
    return found.filter("_first IS NULL OR page_id = _first").select("host", "html")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, low in zip(batch.column("html"), batch.column("low"), strict=True):
            source, low = source.as_py(), low.as_py()
            texts.append(Page(source).text(frozenset(low or ())) if source else "")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """The main text of every page: (page_id, url, text, n_chars).

    Null or empty html gives an empty text; pages without a host share the empty host; rows that
    repeat each give a row; an empty table gives none. Only ``page_id``, ``url`` and
    ``html`` are read. A page is held whole by one task.
    """
    source = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.col("html").cast("string"),
        F.coalesce(F.lower(F.expr("try_parse_url(url, 'HOST')")), F.lit("")).alias("host"),
    )
    low = scratch(low_branches(style_tree(distinct_pages(source, scratch), scratch)))
    side = _side(low, F.length("host") + 8 * F.size("low"))
    return source.join(side, "host", "left").select("page_id", "url", "html", "low").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
