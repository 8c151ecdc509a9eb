"""Main text of web pages by tag-path ratios.

Every text node has a path of open block elements from the root; inline elements
are no part of it, so that their text shares the fate of its block. Per path,
characters, punctuation and link text of all its nodes are summed; their ratios
to the number of blocks are fused, weighted by what the tags and classes on the
path say, and smoothed over paths that share ancestors. Nodes whose path reaches
a share of the page's best value are content. So is what stands between them,
tables and lists of links included, and everything below what says that it is
content, except what is never content. Content is cut into blocks at block
elements. A header, that of an article included, is never content.

All steps take time and memory in proportion to the page, whatever its markup.
"""

from __future__ import annotations

import html
import math
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import sliced, table

# Element names of HTML, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
# Opening one of these ends open elements of the given names, up to the next of SCOPES.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select article section main div body".split())
CONTAINERS = frozenset("div section center td blockquote body html".split())

ASIDE_TAGS = frozenset("nav header footer aside button select menu dialog svg head object".split()) | RAW
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner comment comments comment-list cookie cookies disqus footer form header"
    " masthead menu menubar nav navbar navigation newsletter notice notices respond sidebar signup sponsor sponsored subscribe".split()
)
# These count only outside of what says that it is content.
OUTER_WORDS = frozenset("breadcrumb breadcrumbs modal pagination popup promo promotion related share sharing social toolbar widget".split())
# The two parts of a class name, joined by a hyphen or an underscore; the second may be a number too.
ASIDE_STARTS = frozenset("ad ads advert comment comments sidebar cookie cookies".split())
ASIDE_PARTS = frozenset(
    "area banner bar block body box column consent container content footer form frame header inner label left links list message"
    " notice panel popup primary right secondary section slot space text thread title unit widget wrap wrapper".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset("article article-body articlebody entry-content main-content post-body post-content story".split())

MAIN_WEIGHT = 8.0
MAIN_SHARE = 0.2  # of the characters that are not ruled out; with as many below article or main, text beside them goes
KEEP_SHARE = 0.2  # of the best smoothed value; less than this separates weighted from unweighted paths
HELD_SHARE = 0.9  # of the kept characters, held by the element that holds the content
LINK_SHARE = 0.3  # what text in links counts
OWN, PARENT, GRANDPARENT = 0.5, 0.3, 0.2

NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。]")


class Tags:
    """Where a tag that begins at a place of the page ends: what quotes and angles follow is computed once, from the last one back."""

    def __init__(self, page: str):
        self.places = array("q", (m.start() for m in re.finditer("[>\"']", page)))
        n = len(self.places)
        self.plain, self.quoted = array("q", [-1]) * n, array("q", [-1]) * n
        plain, after = -1, {'"': n, "'": n}
        for i in range(n - 1, -1, -1):
            mark = page[self.places[i]]
            if mark == ">":
                plain = self.quoted[i] = self.places[i]
            else:
                closing, after[mark] = after[mark], i
                self.quoted[i] = self.quoted[closing + 1] if closing + 1 < n else -1
            self.plain[i] = plain

    def end(self, at: int, quotes: bool = True) -> int:
        """The place of the ``>`` that ends the tag, one outside quotes if there is such a one, or -1."""
        i = bisect_left(self.places, at)
        if i == len(self.places):
            return -1
        return self.quoted[i] if quotes and self.quoted[i] >= 0 else self.plain[i]


def _aside_name(word: str, outer: bool) -> bool:
    first = word.split("__")[0]
    if word in ASIDE_WORDS or first in ASIDE_WORDS or (outer and (word in OUTER_WORDS or first in OUTER_WORDS)):
        return True
    start, *rest = re.split("[_-]", word, maxsplit=1)
    return start in ASIDE_STARTS and bool(rest) and (rest[0] in ASIDE_PARTS or rest[0].isdigit())


def _weight(tag: str, attributes: str, within: bool) -> tuple[float, bool]:
    """0 for what is never content, MAIN_WEIGHT for what says it is, else 1; and whether a name or a form speaks against it.

    ``within``: whether it stands in what says that it is content.
    """
    if tag in ASIDE_TAGS:
        return 0.0, False
    weight, doubted = MAIN_WEIGHT if tag in MAIN_TAGS else 1.0, tag == "form"
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                return 0.0, False
            words = set(value.split())
            if name == "role" and words & ASIDE_ROLES:
                return 0.0, False
            doubted |= (name == "role" and "form" in words) or (name in ("class", "id") and any(_aside_name(w, not within) for w in words))
            if (name == "role" and "main" in words) or (name == "itemprop" and "articlebody" in words) or (name in ("class", "id") and words & MAIN_WORDS):
                weight = MAIN_WEIGHT
    return weight, doubted and tag not in ("html", "body")


class Element:
    """An open or closed element; the root of a page has no parent. ``path`` numbers the block elements from the root to it."""

    __slots__ = ("article", "chars", "doubted", "holds", "main", "parent", "path", "tag", "weight", "within")

    def __init__(self, parent: Element | None, tag: str, path: int, weight: float, doubted: bool):
        self.parent, self.tag, self.path, self.weight, self.doubted = parent, tag, path, weight, doubted
        self.main, self.article = tag in MAIN_TAGS, tag == "article" or (parent is not None and parent.article)
        self.within = weight == MAIN_WEIGHT or (parent is not None and parent.within)
        self.chars, self.holds = 0, False  # of it and all it holds; whether it holds an article or main


def _settle(elements: list[Element]) -> None:
    """The weights that count, of elements in page order.

    A name or a form rules an element out unless it holds an article or a main
    element that is not ruled out itself, or, outside articles, more than half
    of the page's text.
    """
    for e in reversed(elements):
        e.parent.chars += e.chars
    half = elements[0].parent.chars / 2 if elements else 0
    for e in reversed(elements):
        if e.doubted and (e.holds or (e.chars > half and not e.parent.article)):
            e.doubted = False
        if e.doubted:
            e.weight = 0.0
        e.parent.holds |= e.weight > 0 and (e.main or e.holds)
    for e in elements:
        e.weight = 0.0 if e.weight == 0 or e.parent.weight == 0 else max(e.weight, e.parent.weight)


class Page:
    """The text of a page in order, its elements, and its paths.

    ``nodes``: (element, text, whether a block ends before it, whether it is a
    link's). ``above``: for each path the path of its parent; path 0 is the
    root's, and its own parent.
    """

    def __init__(self, page: str):
        self.root = Element(None, "", 0, 1.0, False)
        self.nodes: list[tuple[Element, str, bool, bool]] = []
        self.elements: list[Element] = []
        self.above = [0]
        self._paths: dict[tuple[int, str], int] = {}
        self._stack: list[Element] = []
        self._open: dict[str, list[int]] = defaultdict(list)  # depths of the open elements of a name
        self._scopes: list[int] = []  # depths of the open SCOPES
        self._broken = True
        self._read(page)
        _settle(self.elements)

    def _text(self, raw: str) -> None:
        if not raw or not self._stack and not raw.strip():
            return
        text = html.unescape(raw) if "&" in raw else raw
        element = self._stack[-1] if self._stack else self.root
        element.chars += len(text.strip())
        self.nodes.append((element, text, self._broken, bool(self._open["a"])))
        self._broken = False

    def _close(self, depth: int) -> None:
        """End the element at ``depth`` and all that stands open in it."""
        while len(self._stack) > depth:
            tag = self._stack.pop().tag
            self._open[tag].pop()
            if tag in SCOPES:
                self._scopes.pop()

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._broken = True
            if self._open["p"]:  # a block ends the open paragraph; no scope can be open in that
                self._close(self._open["p"][-1])
        if tag in ENDS:
            scope = self._scopes[-1] if self._scopes else -1
            ended = [self._open[name][-1] for name in ENDS[tag] if self._open[name] and self._open[name][-1] > scope]
            if ended:
                self._close(min(ended))
        if tag == "br":
            self._text(" ")
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCK):
            return
        above = self._stack[-1] if self._stack else self.root
        path = above.path
        if tag in BLOCK:
            path = self._paths.setdefault((above.path, tag), len(self.above))
            if path == len(self.above):
                self.above.append(above.path)
        self._open[tag].append(len(self._stack))
        if tag in SCOPES:
            self._scopes.append(len(self._stack))
        self._stack.append(Element(above, tag, path, *_weight(tag, attributes, above.within)))
        self.elements.append(self._stack[-1])

    def _read(self, page: str) -> None:
        tags, at, n = Tags(page), 0, len(page)
        begun = 0  # of the text that is not yet a node

        while True:
            at = page.find("<", at)
            if at < 0:
                break
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                end = n if end < 0 else end + 3
                self._text(page[begun:at])
                at = begun = end
                continue
            m = None if page.startswith(("<!", "<?"), at) else NAME.match(page, at)
            end = tags.end(m.end() if m else at, quotes=m is not None) if m or page.startswith(("<!", "<?"), at) else -1
            if end < 0:  # no tag: text
                at = m.end() if m else at + 1
                continue
            self._text(page[begun:at])
            start, at = at, end + 1
            begun = at
            if not m:
                continue
            tag = m[1].lower()
            if page[start + 1] == "/":
                if self._open[tag]:
                    self._close(self._open[tag][-1])
                self._broken |= tag in BLOCK
            elif tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
                end = tags.end(closing.end(), quotes=False) if closing else -1
                at = begun = n if end < 0 else end + 1
            else:
                self._start(tag, page[m.end() : end])
        self._text(page[begun:])


def path_values(page: Page) -> dict[tuple[int, float], float]:
    """The fused and smoothed value of each path and weight that holds text."""
    sums: dict[tuple[int, float], list[int]] = {}  # blocks, characters, those of links, punctuation, last block
    block = 0
    for element, text, broken, link in page.nodes:
        block += broken
        filled = text.strip()
        if filled:
            s = sums.setdefault((element.path, element.weight), [0, 0, 0, 0, -1])
            s[0] += s[4] != block
            s[1] += len(filled)
            s[2] += link * len(filled)
            s[3] += len(PUNCTUATION.findall(filled))
            s[4] = block
    fused = {}
    for (path, weight), (n, chars, linked, marks, _) in sums.items():
        fused[path, weight] = weight * (1 - (1 - LINK_SHARE) * linked / chars) * (math.log1p(chars / n) + math.log1p(marks / n))
    # of the paths that share a parent, and of those that share a grandparent
    shared: list[dict[int, list[float]]] = [defaultdict(lambda: [0.0, 0]), defaultdict(lambda: [0.0, 0])]
    for (path, weight), value in fused.items():
        if weight:
            for place, totals in zip((page.above[path], page.above[page.above[path]]), shared):
                totals[place][0] += value
                totals[place][1] += 1
    values = {}
    for (path, weight), value in fused.items():
        near, far = shared[0][page.above[path]], shared[1][page.above[page.above[path]]]
        values[path, weight] = OWN * value + PARENT * near[0] / near[1] + GRANDPARENT * far[0] / far[1] if weight else 0.0
    return values


def _filled(page: Page, wanted: list[bool]) -> list[bool]:
    """``wanted`` with all text that is not ruled out and that stands in the element that holds the content.

    That is the deepest container with HELD_SHARE of the wanted characters. All
    its text counts if half of them stand in its own blocks and it is not the
    body, else what lies between its first wanted node and its last.
    """
    held: dict[Element, int] = defaultdict(int)
    own: dict[Element, int] = defaultdict(int)
    total = 0
    for (element, text, _, _), w in zip(page.nodes, wanted):
        if w:
            size = len(text.strip())
            total += size
            held[element] += size
            own[element] += size
    if not total:
        return wanted
    for e in reversed(page.elements):
        held[e.parent] += held.get(e, 0)
    holder = page.root
    for e in page.elements:  # those that hold so much lie in each other
        if e.tag in CONTAINERS and held.get(e, 0) >= HELD_SHARE * total:
            holder = e
    inside = {holder: True}
    near = {holder: True}  # whether its text belongs to a block of the holder's own
    for e in page.elements:
        inside[e] = e is holder or inside.get(e.parent, False)
        near[e] = e is holder or (near.get(e.parent, False) and (e.tag not in BLOCK or e.parent is holder or e.parent.tag not in BLOCK))
    direct = sum(size for e, size in own.items() if near.get(e, False))
    first, last = 0, len(wanted)
    if holder is page.root or holder.tag in ("html", "body") or 2 * direct < total:
        places = [i for i, (w, (e, text, _, _)) in enumerate(zip(wanted, page.nodes)) if w and inside.get(e, False) and text.strip()]
        first, last = places[0], places[-1]
    return [w or (first <= i <= last and node[0].weight > 0 and inside.get(node[0], False)) for i, (w, node) in enumerate(zip(wanted, page.nodes))]


def main_text(page: str) -> str:
    """The content blocks of ``page``, one per line."""
    read = Page(page)
    sizes = [len(text.strip()) for _, text, _, _ in read.nodes]
    main = [element.weight >= MAIN_WEIGHT for element, _, _, _ in read.nodes]
    allowed = sum(size for size, (element, _, _, _) in zip(sizes, read.nodes) if element.weight > 0)
    wanted = main
    if sum(size for size, m in zip(sizes, main) if m) < MAIN_SHARE * allowed or not any(main):
        values = path_values(read)
        least = KEEP_SHARE * max(values.values(), default=0.0)
        value = [values.get((element.path, element.weight), 0.0) for element, _, _, _ in read.nodes]
        wanted = _filled(read, [m or (size > 0 and v > 0 and v >= least) for m, size, v in zip(main, sizes, value)])
    blocks: list[list[str]] = [[]]
    for w, size, (element, text, broken, _) in zip(wanted, sizes, read.nodes):
        if broken:
            blocks.append([])
        if w or (size == 0 and element.weight > 0):
            blocks[-1].append(text)
    return "\n".join(filter(None, (" ".join("".join(b).split()) for b in blocks)))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 2):
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``, in one pass without a shuffle.

    A null or empty html, or a page without content, gives an empty text. Broken
    markup is read as far as it goes, and very long pages take time and memory in
    proportion, a page at a time. Null ids and addresses stay null, repeated
    rows are extracted each by itself, an empty table gives no rows, and other
    columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


def op4_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
