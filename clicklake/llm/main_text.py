"""Main text of web pages by tree scoring.

A page is read into a tree as browsers do: end tags that are left out are implied, what stands in
scripts and styles is no text, character references are decoded. Menus, headers, footers, sidebars,
notices, adverts, forms and reader comments are known by their tags, roles, and class or id words, and go
with all they hold. Names and forms are looked at twice: "with-sidebar" may name what holds the article,
"related-work" a part of it, and a form may be wrapped around a whole page (``_drop_named``).

Each paragraph then passes points to the containers above it: one, one for each comma, and one for each
hundred characters up to three. Its parent gets all of them, the next ancestor half, further ones
less. A container's sum is discounted by its link density. The best container is the article; if it lies
within an ``article`` element, or else a ``main`` element, that is taken as a whole. All beside it, and beside the
containers above it, that is not mostly links is taken as well, however little it scores; a ``main`` element
tells where to stop.

The text is all that is left in what was chosen: white space within a block becomes one space, blocks are
joined by one space in page order, and nothing is capped. Time is in proportion to the page, however it is nested.

Pages are independent of each other, so there is no shuffle. Defined results: a null or empty page, and
one without text, have an empty text; equal pages have equal texts; of equal scores the container that
begins first wins.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from clicklake.llm.common import free_name, steps

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
CLOSING = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noembed", "xmp")}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("body caption html legend tbody td tfoot th thead tr".split())
# A start tag ends an open one of these, looked for up to the given elements.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
PARAGRAPH_SCOPE = frozenset("html td th table caption button object template".split())
PARAGRAPHS = frozenset("p pre td li blockquote dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

DROPPED_TAGS = frozenset(
    "head nav footer aside script style noscript template iframe button select textarea svg object embed annotation annotation-xml "
    "canvas audio video dialog menu search fieldset label title noembed xmp".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidenav footer masthead topbar ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments disqus respond replies reply widget toolbar pagination pager".split()
)
# Words that say which part of a page an element is, and nothing of what it tells.
STRUCTURE = frozenset(
    "area bar bars block blocks body bottom box button buttons card cards col column container content count desktop element feed float "
    "fixed form global group header icon icons inner item items js layout left link links list lists main meta middle mobile module "
    "outer page panel pane part post posts primary right row secondary section site slot small large space spot sticky stories story "
    "tab tabs text thread title toggle tool tools top unit user users wrap wrapper zone".split()
)
DROPPED_NAMES = frozenset("header site-header page-header top-header siteheader pageheader".split())
NEVER_DROPPED = frozenset("html body main".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


# Whether an element goes: not, for sure, or perhaps, which is looked at again once the page is read. A plain name is
# made of dropped words and words of structure ("sidebar-left"); another one has words of its own ("with-sidebar",
# "related-work") and tells little. A form may be wrapped around a whole page.
STAYS, GOES, PLAINLY_NAMED, PARTLY_NAMED, FORM = range(5)


def _is_dropped(tag: str, raw: str) -> int:
    if tag in DROPPED_TAGS:
        return GOES
    if tag == "form":
        return FORM
    if not raw.strip(" /") or tag in NEVER_DROPPED:
        return STAYS
    given = _attributes(raw)
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return GOES
    if "display:none" in given.get("style", "").lower().replace(" ", ""):
        return GOES
    if DROPPED_ROLES & set(given.get("role", "").lower().split()):
        return GOES
    found = STAYS
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        words = {w.lower() for w in WORD.findall(name) if not w.isdigit()}
        if name.lower() in DROPPED_NAMES or words & DROPPED_WORDS and words <= DROPPED_WORDS | STRUCTURE:
            return PLAINLY_NAMED
        if words & DROPPED_WORDS:
            found = PARTLY_NAMED
    return found


class _Page:
    """The tree of a page: elements in order of their start, and blocks of text."""

    def __init__(self) -> None:
        self.tag, self.parent, self.gone = ["#"], [0], [False]
        self.named, self.under = [STAYS], [0]  # by names; the innermost element dropped by its names
        self.block = [0]  # the innermost block that an element is or stands in
        self.open = [0]
        self.depths: dict[str, list[int]] = {}  # of the open elements of each tag
        self.block_depths = [-1]  # of the open blocks
        # Element, and pieces of its text: that element dropped by its names, text, characters, characters in links.
        self.blocks: list[tuple[int, list[tuple[int, str, int, int]]]] = []
        self.in_link = 0
        self.fresh = True

    def start(self, tag: str, raw: str) -> None:
        if tag in ENDS_PARAGRAPH:
            self._end_open(frozenset(["p"]), PARAGRAPH_SCOPE)
        if tag in IMPLIED:
            self._end_open(*IMPLIED[tag])
        if tag == "a":
            self._end_open(frozenset(["a"]), BLOCKS)
        above = self.open[-1]
        gone = self.gone[above]
        named = STAYS if gone else _is_dropped(tag, raw)
        gone |= named == GOES
        if tag in BLOCKS:
            self.fresh = True
        self.tag.append(tag), self.parent.append(above), self.gone.append(gone), self.named.append(named)
        self.block.append(len(self.block) if tag in BLOCKS else self.block[above])
        self.under.append(len(self.under) if named not in (STAYS, GOES) else self.under[above])
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            if tag in BLOCKS:
                self.block_depths.append(len(self.open))
            self.open.append(len(self.tag) - 1)
            self.in_link += tag == "a"

    def end(self, tag: str) -> None:
        self._end_open((tag,), () if tag in BLOCKS else BLOCKS)

    def _innermost(self, tags) -> int:
        if tags is BLOCKS:
            return self.block_depths[-1]
        return max((self.depths[tag][-1] for tag in tags if self.depths.get(tag)), default=-1)

    def _end_open(self, tags, scope) -> None:
        """Close the innermost open element of ``tags``, unless one of ``scope`` is open within it.

        Depths are kept by tag, so this takes a time that does not grow with the number of open elements.
        """
        depth = self._innermost(tags)
        if depth < 0 or scope and self._innermost(scope) > depth:
            return
        for node in self.open[depth:]:
            tag = self.tag[node]
            self.depths[tag].pop()
            self.in_link -= tag == "a"
            if tag in BLOCKS:
                self.fresh = True
                self.block_depths.pop()
        del self.open[depth:]

    def text(self, raw: str) -> None:
        node = self.open[-1]
        if self.gone[node] or not raw:
            return
        under = self.under[node]
        if self.fresh:
            if raw.isspace():
                return
            self.blocks.append((self.block[node], []))
            self.fresh = False
        raw = html.unescape(raw) if "&" in raw else raw
        size = len(raw.strip())
        self.blocks[-1][1].append((under, raw, size, size if self.in_link else 0))


def _read(source: str) -> _Page:
    page = _Page()
    at, size = 0, len(source)
    while at < size:
        found = TOKEN.search(source, at)
        if not found:
            page.text(source[at:])
            break
        page.text(source[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            page.end(tag)
            if tag == "br":
                page.text(" ")
            continue
        raw = found[3] if found[2] else found[6]
        if tag in ("br", "wbr", "img"):
            page.text(" " if tag == "br" else "")
            continue
        page.start(tag, raw)
        if tag in CLOSING:
            end = CLOSING[tag].search(source, at)
            at = end.start() if end else size
    return page


def main_text(source: str | None) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = _read(source)
    n = len(page.tag)
    # A header within an article belongs to it if it has the title.
    _settle_headers(page)
    _drop_named(page)
    blocks = _blocks(page)
    if not blocks:
        return ""
    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    for node, text, (size, in_links) in blocks:
        chars[node] += size
        linked[node] += in_links
        if page.tag[node] in HEADINGS:
            continue
        own = _points(text, size, in_links)
        above = page.parent[node] if page.tag[node] in PARAGRAPHS else node
        for level in range(6):
            points[above] += own / (1, 2, 6, 9, 12, 15)[level]
            if not above:
                break
            above = page.parent[above]
    for node in range(n - 1, 0, -1):
        chars[page.parent[node]] += chars[node]
        linked[page.parent[node]] += linked[node]
    score = [p * (1 - k / max(1, c)) for p, k, c in zip(points, linked, chars)]
    best = max(range(n), key=score.__getitem__)
    # The article or main element around the best container is taken as a whole; so is what reads like text beside an
    # article, unless a main element tells where to stop.
    whole = _around(page, best, "article") or _around(page, best, "main") or best
    limit = _around(page, whole, "main")
    chosen, above = {whole}, set()
    if score[best] > 0 and whole != limit:
        chosen |= _beside(page, whole, chars, linked, limit)
        node = whole
        while node != limit:
            node = page.parent[node]
            above.add(node)
    inside = [False] * n
    for node in range(n):
        inside[node] = node in chosen or (node > 0 and inside[page.parent[node]])
    return " ".join(text for node, text, counts in blocks if inside[node] or node in above and _reads(*counts))


def _blocks(page: _Page) -> list[tuple[int, str, list[int]]]:
    """Element, text, and characters and those in links, of each block that has text left."""
    made = []
    for node, pieces in page.blocks:
        if page.gone[node]:
            continue
        left = [piece for piece in pieces if not page.gone[piece[0]]]
        text = " ".join("".join(piece[1] for piece in left).split())
        if text:
            made.append((node, text, [sum(piece[2] for piece in left), sum(piece[3] for piece in left)]))
    return made


def _points(text: str, size: int, in_links: int) -> float:
    own = 1 + text.count(",") + text.count("،") + text.count("、") + text.count("，") + min(3, len(text) // 100)
    return own * (1 - in_links / max(1, size))


def _drop_named(page: _Page) -> None:
    """Drop elements by their names, and forms, except those that hold the article.

    A partly dropped name is not enough: the element goes only if it is outside every ``article`` and ``main`` and more
    than a third of its text is links. A form stays, unwrapped, if it holds more than half of the page's points, a ``main``, or
    the ``article`` with most points if that has a title. If less than a twentieth of the points would be left, and no
    article, then all that hold more than half stay, or all if none does.
    """
    named = [node for node, how in enumerate(page.named) if how not in (STAYS, GOES) and not page.gone[node]]
    if not named:
        return
    n = len(page.tag)
    points, mains, titles = [0.0] * n, [page.tag[node] == "main" and not page.gone[node] for node in range(n)], [False] * n
    chars, linked, in_article = [0] * n, [0] * n, [False] * n
    for node, text, (size, in_links) in _blocks(page):
        titles[node] |= page.tag[node] in ("h1", "h2")
        if page.tag[node] not in HEADINGS:
            points[node] += _points(text, size, in_links)
        chars[node] += size
        linked[node] += in_links
    for node in range(n - 1, 0, -1):
        above = page.parent[node]
        points[above] += points[node]
        chars[above] += chars[node]
        linked[above] += linked[node]
        mains[above] |= mains[node]
        titles[above] |= titles[node]
    for node in range(1, n):
        above = page.parent[node]
        in_article[node] = in_article[above] or page.tag[above] in ("article", "main")
    articles = [node for node in range(n) if page.tag[node] == "article" and not page.gone[node] and points[node]]
    top = max(articles, key=points.__getitem__, default=0)
    holds_top, node = set(), top if titles[top] else 0
    while node:
        holds_top.add(node)
        node = page.parent[node]
    most = {node for node in named if 2 * points[node] > points[0]}
    spared = {node for node in named if page.named[node] == PARTLY_NAMED and (in_article[node] or 3 * linked[node] <= chars[node])}
    spared |= {node for node in named if page.named[node] != PLAINLY_NAMED and (node in most or mains[node] or node in holds_top)}

    def dropped(spared: set[int]) -> list[bool]:
        gone = list(page.gone)
        for node in range(1, n):
            gone[node] |= gone[page.parent[node]] or page.under[node] == node and node not in spared
        return gone

    gone = dropped(spared)
    lost = sum(points[node] for node in named if gone[node] and not gone[page.parent[node]])
    if lost and (20 * (points[0] - lost) < points[0] and all(gone[node] for node in articles) or lost >= points[0]):
        gone = dropped(spared | (most or set(named)))
    page.gone = gone


def _reads(chars: int, linked: int) -> bool:
    """Whether text is more than links; in short text no link may be."""
    return 4 * linked < chars if chars > 80 else not linked


def _around(page: _Page, node: int, tag: str) -> int:
    """The innermost element of a tag that is or holds ``node``, 0 if there is none."""
    while node and page.tag[node] != tag:
        node = page.parent[node]
    return node


def _beside(page: _Page, best: int, chars: list[int], linked: list[int], limit: int) -> set[int]:
    """What stands beside the chosen container, or beside one above it up to ``limit``, and reads like text, however short.

    Of what is mostly links, only parts of more than 80 characters that read like text are taken.
    """
    path, above = {best}, best
    while above != limit:
        above = page.parent[above]
        path.add(above)
    found, linky = set(), set()
    for node in range(1, len(page.tag)):
        above = page.parent[node]
        if node in path or page.gone[node] or not chars[node] or not (above in linky or above in path and above != best):
            continue
        reads = _reads(chars[node], linked[node])
        if above in linky:
            taken = reads and chars[node] > 80
        else:
            taken = reads or above == page.parent[best] and page.tag[node] in HEADINGS
        (found if taken else linky).add(node)
    return found


def _settle_headers(page: _Page) -> None:
    headers = [node for node, tag in enumerate(page.tag) if tag == "header" and not page.gone[node]]
    if not headers:
        return
    titled, in_article = set(), [False] * len(page.tag)
    for node in range(1, len(page.tag)):
        in_article[node] = in_article[page.parent[node]] or page.tag[node] in ("article", "main")
        if page.tag[node] in HEADINGS:
            above = node
            while above:
                titled.add(above)
                above = page.parent[above]
    for node in headers:
        page.gone[node] = not (in_article[node] and node in titled)
    for node in range(1, len(page.tag)):
        page.gone[node] |= page.gone[page.parent[node]]


def extract(pages: DataFrame, source: str = "html", name: str = "text") -> DataFrame:
    """The columns other than ``source``, with the main text and its number of characters."""
    held = [f for f in pages.schema.fields if f.name != source]
    rest = pages.select([f.name for f in held])
    names = [free_name(rest, name), free_name(rest, "n_chars")]
    schema = StructType([*held, StructField(names[0], StringType()), StructField(names[1], LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, source):
            texts = [main_text(value) for value in step.column(source).to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*(step.column(f.name) for f in held), *made], names=[*(f.name for f in held), *names]
            )

    return pages.mapInArrow(run, schema)
