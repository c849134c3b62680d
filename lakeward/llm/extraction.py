"""Main text of web pages by site style trees.

1. Each page is parsed into elements.  An element's *path* is what its
   ancestors and itself look like (tag, classes, id with digits masked, role);
   siblings that look alike share it, so the pages of a host merge into one
   tree, whose size follows the variety of its templates and not its pages.
2. Per host and path, Spark counts the styles (sequences of children) and the
   contents (own texts) that pages show there, a page's copies once.  Their
   entropies, in units of the number of pages, are the importance of
   presentation and of content: 0 if all pages agree, 1 if all differ or only
   one page has it.
3. Each page is read again with its host's values.  A branch's importance
   combines both from the leaves up; a branch without any important element is
   removed.

Entropy cannot tell what differs on every page although it is no article
(readers' comments), nor judge a host with one page.  So elements that HTML or
their names declare to be something else (``nav``, ``aside``, ``form``, class
``comments`` ...) have no importance, and what ``article`` or ``main`` declares
to be the text is important as a whole: there only elements with a look of
their own are judged, and none that hold half of it.

Blocks (paragraphs, headings, list items, cells ...) are joined by one line
feed, white space within one (a line break included) is one space.  A null or
empty page has an empty text; a null url belongs to no host, so only
declarations count; repeated rows are extracted one by one and counted once;
broken markup is read as browsers do in the main (unclosed paragraphs, missing
end tags, stray ``<``); pages of any length are read whole; other columns are
ignored and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_library
from .texts import Folder
from .urls import host_of

#: A branch whose elements all have less is removed.
THRESHOLD = 0.5
#: How fast the variety of an element's styles outweighs its children.
DAMPING = 0.9

# Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noembed noframes xmp iframe".split())
APART = frozenset(
    "script style title textarea noembed noframes xmp iframe noscript template object svg math canvas audio video "
    "nav header footer aside menu dialog form button select datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
FLOW = INLINE | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure figcaption "
    "hr address details summary center".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag closes, besides an open paragraph.
_ROWS = frozenset("td th tr".split())
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "tr": _ROWS,
    **{t: _ROWS | {"tbody", "thead", "tfoot"} for t in ("tbody", "thead", "tfoot")},
    "option": frozenset(["option"]),
    "optgroup": frozenset(["option", "optgroup"]),
}
#: Menus that an article cannot stand in: their end tag is missing.
CLOSED_BY_TEXT = {"article": frozenset(["nav"]), "main": frozenset(["nav", "header", "footer"])}
#: Elements that an end tag or a sibling inside them does not close.
SCOPES = frozenset("html body article main section div table td th ul ol dl aside nav header footer form".split())
#: Words in a class, id or role that tell what an element is.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos "
    "promotion banner popup modal overlay cookie cookies consent gdpr notice notices notification alert newsletter "
    "subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside "
    "complementary contentinfo widget widgets footer masthead topbar toolbar comment comments commentlist disqus reply "
    "replies respond social share sharing sharebar related recommended recommendations teaser teasers pager pagination "
    "copyright search skip toc".split()
)
#: Such a word says nothing after one of the first, or before one of the second.
ABSENT = frozenset("no has with without not is category tag".split())
STATE = frozenset("open opened closed enabled disabled off none count".split())
#: ``header``, alone or after one of these, is a page's.
WHOLE_PAGE = frozenset("site page global top main".split())

_TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)([^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>"
    r"|(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|[a-zA-Z!?/][^>]*(?:>|\Z))",
    re.S,
)
_LOOK = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I | re.S)
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")

NODES = "host string, path long, page long, style long, content long"
MAIN_TEXT = "page_id long, url string, text string"


def _code(*parts) -> int:
    raw = "\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


class Looks:
    """What tags with attributes look like; known ones are kept."""

    def __init__(self, most: int = 1 << 16):
        self.most = most
        self.looks: dict[tuple[str, str], tuple[str, bool, bool]] = {}
        self.paths: dict[tuple[int, str], int] = {}

    def look(self, tag: str, attributes: str) -> tuple[str, bool, bool]:
        """(look, whether its names tell it apart, whether it is the article)"""
        if "=" not in attributes or not (found := _LOOK.findall(attributes)):
            return tag, False, False
        key = (tag, " ".join(f"{a.lower()}={v}" for a, v in found))
        if key not in self.looks:
            if len(self.looks) >= self.most:
                self.looks.clear()
            values = [(a.lower(), html.unescape(v.strip("\"'")).lower().split()) for a, v in found]
            shown = " ".join(
                f"{a}={','.join(sorted(_DIGITS.sub('0', x) for x in v))}" for a, v in sorted(values) if a != "itemprop"
            )
            named = any(self._tells(tag, x) for a, v in values if a != "itemprop" for x in v)
            article = any(
                (a == "role" and ("article" in v or "main" in v)) or (a == "itemprop" and "articlebody" in v)
                for a, v in values
            )
            self.looks[key] = (f"{tag} {shown}", named, article)
        return self.looks[key]

    @staticmethod
    def _tells(tag: str, name: str) -> bool:
        words = _WORD.findall(name)
        if words and words[-1] == "header" and (len(words) == 1 or words[0] in WHOLE_PAGE):
            return True
        for k, w in enumerate(words[:1] if tag == "article" else words):
            if w in NAMED and not (k and words[k - 1] in ABSENT) and not STATE & set(words[k + 1 : k + 2]):
                return True
        return False

    def path(self, parent: int, look: str) -> int:
        if (parent, look) not in self.paths:
            if len(self.paths) >= self.most:
                self.paths.clear()
            self.paths[parent, look] = _code(parent, look)
        return self.paths[parent, look]


class Page:
    """Elements of a page in order (a parent comes before its children) and its
    blocks of text, each a list of (element, text)."""

    def __init__(self, source: str, looks: Looks):
        self.tags, self.parents, self.paths = ["#page"], [-1], [0]
        self.named, self.landmark, self.plain = [False], [False], [False]
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self._read(source, looks)

    def _read(self, source: str, looks: Looks) -> None:
        stack, tags = [0], self.tags
        self.open: Counter[str] = Counter()
        position, end = 0, len(source)
        while position < end:
            m = _TAG.search(source, position)
            if m is None:
                self._text(stack[-1], source[position:])
                break
            if m.start() > position:
                self._text(stack[-1], source[position : m.start()])
            position = m.end()
            closing, tag, attributes = m.group(1), m.group(2), m.group(3)
            if not tag:
                closing, tag, attributes = m.group(4), m.group(5), m.group(6)
                if not tag:
                    continue
            tag = tag.lower()
            inline = tag in INLINE
            if not inline:
                self._cut()
            elif tag == "br":
                self.blocks[-1].append((stack[-1], " "))
            if closing:
                self._close(stack, tag, inline)
                continue
            if not inline:
                self._make_room(stack, tag)
            if tag in VOID:
                continue
            look, named, article = looks.look(tag, attributes)
            if inline and look == tag and tags[stack[-1]] not in INLINE:
                continue  # its text is its parent's
            at = len(tags)
            tags.append(tag)
            self.parents.append(stack[-1])
            self.paths.append(looks.path(self.paths[stack[-1]], look))
            self.named.append(named and tag not in ("html", "body", "main"))
            self.landmark.append(article or tag in ("article", "main"))
            self.plain.append(look == tag and tag in FLOW)
            if tag in RAW:
                # text up to the end tag is not markup; none of it is kept
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, position)
                position = close.end() if close else end
            elif not (attributes.endswith("/") and tag in ("svg", "math")):
                stack.append(at)
                self.open[tag] += 1

    def _text(self, element: int, raw: str) -> None:
        self.blocks[-1].append((element, html.unescape(raw) if "&" in raw else raw))

    def _cut(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _drop(self, stack: list[int], k: int) -> None:
        for i in stack[k:]:
            self.open[self.tags[i]] -= 1
        del stack[k:]

    def _close(self, stack: list[int], tag: str, inline: bool) -> None:
        if not self.open[tag]:
            return
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[k]]
            if open_tag == tag:
                self._drop(stack, k)
                return
            if inline and open_tag not in INLINE:
                return
            # a stray end tag ends neither the text nor, if it is a small one, what it stands in
            if open_tag in SCOPES and (tag not in SCOPES or open_tag in ("article", "main", "td", "th")):
                if tag not in ("body", "html"):
                    return

    def _make_room(self, stack: list[int], tag: str) -> None:
        """Close what ``tag`` cannot stand in."""
        menus = CLOSED_BY_TEXT.get(tag)
        if menus and any(self.open[t] for t in menus):
            k = next((k for k, i in enumerate(stack) if self.tags[i] in menus), 0)
            if k:
                self._drop(stack, k)
        closes = CLOSES.get(tag, frozenset())
        if not self.open["p"] and not any(self.open[t] for t in closes):
            return
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[k]]
            if open_tag == "p" or open_tag in closes:
                self._drop(stack, k)
            elif open_tag in SCOPES:
                return

    def _apart(self, own: list[bool]) -> list[bool]:
        """Elements in a branch that is declared to be no text; of a header
        inside the article, headings are text."""
        n = len(self.tags)
        apart, inside, lead, heading = [False] * n, [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            p, tag = self.parents[i], self.tags[i]
            inside[i] = inside[p] or self.landmark[i]
            heading[i] = heading[p] or tag in HEADINGS
            lead[i] = (tag == "header" and inside[p] and not apart[p]) or (lead[p] and not own[i])
            apart[i] = not heading[i] if lead[i] else apart[p] or own[i]
        return apart

    def declared(self) -> tuple[list[bool], list[bool]]:
        """(in a branch that is declared to be no text, in the main text)"""
        n = len(self.tags)
        own = [tag in APART or named for tag, named in zip(self.tags, self.named, strict=True)]
        apart = self._apart(own)
        marks = [i for i in range(1, n) if self.landmark[i] and not apart[i]]
        if not marks:
            hidden = [i for i in range(1, n) if self.landmark[i] and not own[i]]
            for i in hidden:
                # an element around the only article is no menu after all
                for above in self._above(i):
                    own[above] = False
            if hidden:
                apart = self._apart(own)
                marks = [i for i in hidden if not apart[i]]
        if not marks:
            return apart, [not a for a in apart]
        articles = {i for i in marks if self.tags[i] != "main"}
        mains = {i for i in marks if self.tags[i] == "main"}
        chosen = articles or mains
        if articles and mains:
            size = self.sizes(apart)
            outer = sum(size[i] for i in articles if not any(a in articles for a in self._above(i)))
            if 2 * outer < sum(size[i] for i in mains):
                chosen = mains
        under = [False] * n
        for i in range(1, n):
            under[i] = under[self.parents[i]] or i in chosen
        return apart, [u and not a for u, a in zip(under, apart, strict=True)]

    def _above(self, i: int) -> Iterator[int]:
        i = self.parents[i]
        while i > 0:
            yield i
            i = self.parents[i]

    def sizes(self, skipped: list[bool]) -> list[int]:
        """Characters of text in each branch, without what is skipped."""
        size = [0] * len(self.tags)
        for block in self.blocks:
            for i, text in block:
                if not skipped[i]:
                    size[i] += len(text)
        for i in range(len(size) - 1, 0, -1):
            size[self.parents[i]] += size[i]
        return size

    def text(self, kept: list[bool]) -> str:
        lines = (" ".join("".join(t for i, t in block if kept[i]).split()) for block in self.blocks)
        return "\n".join(x for x in lines if x)

    def nodes(self) -> dict[int, tuple[int, int]]:
        """path -> (style, content) over all elements of a path."""
        children: dict[int, list[int]] = {p: [] for p in self.paths}
        for i in range(1, len(self.tags)):
            seen = children[self.paths[self.parents[i]]]
            if not seen or seen[-1] != self.paths[i]:
                seen.append(self.paths[i])
        texts: dict[int, list[str]] = {}
        for block in self.blocks:
            for i, text in block:
                if not text.isspace():
                    texts.setdefault(self.paths[i], []).append(text)
        return {p: (hash(tuple(c)), _code(*texts[p]) if p in texts else 0) for p, c in children.items()}

    def unimportant(self, values: dict[int, tuple[float, float, int]], main: list[bool]) -> list[bool]:
        """Branches whose elements all have too little importance, by ``values``:
        path -> (importance of presentation, of content, number of styles)."""
        n = len(self.tags)
        total, parts = [0.0] * n, [0] * n
        has_text = [False] * n
        for block in self.blocks:
            for i, text in block:
                has_text[i] = has_text[i] or not text.isspace()
        highest = [0.0] * n
        for i in range(n - 1, 0, -1):
            shown, said, styles = values.get(self.paths[i], (1.0, 1.0, 1))
            if has_text[i]:
                total[i], parts[i] = total[i] + said, parts[i] + 1
            if parts[i]:
                weight = DAMPING**styles
                own = total[i] / parts[i]
                if parts[i] > has_text[i]:
                    own = (1 - weight) * shown + weight * own
                highest[i] = max(highest[i], own)
                p = self.parents[i]
                total[p], parts[p] = total[p] + own, parts[p] + 1
                highest[p] = max(highest[p], highest[i])
        size = self.sizes([not m for m in main])
        holds = list(self.landmark)
        for i in range(n - 1, 0, -1):
            holds[self.parents[i]] = holds[self.parents[i]] or holds[i]
        whole, low = [0] * n, [False] * n
        for i in range(1, n):
            p = self.parents[i]
            whole[i] = size[i] if self.landmark[i] else whole[p]
            # in a landmark, what holds more than half of its text is not judged
            judged = not self.plain[i] and not holds[i] and (not whole[i] or 2 * size[i] <= whole[i])
            low[i] = low[p] or (judged and highest[i] < THRESHOLD)
        return low


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    looks = Looks()
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source, looks)
            main = page.declared()[1]
            kept = _code(*(t for block in page.blocks for i, t in block if main[i]))
            for path, (style, content) in page.nodes().items():
                for column, value in zip(out, (host, path, kept, style, content), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), *(pa.array(c, pa.int64()) for c in out[1:])],
            ["host", "path", "page", "style", "content"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    looks = Looks()
    for batch in batches:
        texts = []
        for source, tree in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
            page = Page(source or "", looks)
            _, main = page.declared()
            if tree.is_valid:
                t = tree.values
                columns = [t.field(c).to_pylist() for c in ("path", "presentation", "content", "styles")]
                values = dict(zip(columns[0], zip(*columns[1:], strict=True), strict=True))
                low = page.unimportant(values, main)
                main = [m and not x for m, x in zip(main, low, strict=True)]
            texts.append(page.text(main))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def style_trees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, tree) of hosts with more than one page: the paths that pages share
    with the importance of presentation and content and the number of styles;
    a path of one page has importance 1 and is left out."""
    ship_library(pages.sparkSession)
    named = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    named = named.filter("host <> '' AND html <> ''")
    seen = named.mapInArrow(_observe, NODES).distinct()
    by_value = seen.select(
        "host", "path", F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("style", "content")]))
    )
    counts = by_value.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    # -sum(p log p) with p = n / m, in units of log m
    m, spread = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    entropy = F.when(m > 1, 1 - spread / (m * F.log(m.cast("double")))).otherwise(F.lit(1.0))
    per_path = (
        counts.groupBy("host", "path", "kind")
        .agg(m.alias("m"), entropy.alias("importance"), F.count(F.lit(1)).alias("values"))
        .groupBy("host", "path")
        .agg(
            F.max("m").alias("m"),
            F.max(F.when(F.col("kind") == "style", F.col("importance"))).alias("presentation"),
            F.max(F.when(F.col("kind") == "content", F.col("importance"))).alias("content"),
            F.max(F.when(F.col("kind") == "style", F.col("values"))).cast("int").alias("styles"),
        )
    )
    shared = per_path.filter("m > 1 AND (presentation < 1 OR content < 1)")
    tree = F.collect_list(F.struct("path", "presentation", "content", "styles")).alias("tree")
    return shared.groupBy("host").agg(tree)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text) of every page."""
    spark = pages.sparkSession
    # written, so that Spark knows the trees' size when it picks the join
    trees = Folder(spark, "trees").keep(style_trees(pages, url_col, html_col), "trees")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    joined = rows.join(trees, "host", "left").select("page_id", "url", "html", "tree")
    return joined.mapInArrow(_extract, MAIN_TEXT)
