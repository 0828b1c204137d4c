"""Main text of web pages, by smoothed text-to-tag ratios.

The standard library's parser streams events. Text gathers in lines, one per
block of the page; a line knows its characters, its tags and its place among the
containers. Lines inside elements that are no content by their tag (menus,
footers, scripts and the like) are left out at once. What a class, id or role
names as such (sidebar, notice, advert, comments) goes too, however long it is, but never a heading or
what holds an article. A name alone does not make the container of the page go:
an element without running text beside it stays, unless its name stands for
comments, adverts or consent. A form goes unless it holds an article or most of the page's text. Over the
lines that remain, the text-to-tag ratio is smoothed by a Gaussian and split by a threshold into
two clusters; lines of the upper one show where the content is. The region is
the article that holds half of their text or, without one, the smallest
container that holds all of them; every line in it belongs to the result,
however short. Without an article or main element, headings and paragraphs that
stand directly in a container around the region, and what stands beside them,
belong to it as well, and so do the blocks with a first-level heading or with
much text per tag, which the lower of two clusters may hold on a page of prose.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import map_rows

SMOOTHING = 1.0  # standard deviation of the Gaussian, in lines

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody tfoot thead title tr ul".split())
CELLS = frozenset(("td", "th", "br"))  # white space, no block of its own
REGIONS = frozenset("html body main article section div center".split())  # quotations, lists and tables are not entered
BOILERPLATE = frozenset(
    "head script style noscript template nav footer aside menu dialog button select textarea option iframe object "
    "svg math canvas audio video title".split())
CLOSED_BY_BLOCK = frozenset(("p",))
NOT_IN_P = BLOCKS - frozenset(("body", "html", "caption", "legend", "optgroup", "option", "title", "summary", "tr",
                               "tbody", "thead", "tfoot"))
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset(("ul", "ol", "dl", "table", "menu", "select"))
# Words in class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner sponsor sponsored promo "
    "promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login social "
    "share sharing related recommended recommendations comment comments commentlist disqus reply replies respond "
    "pagination pager widget widgets toolbar contentinfo complementary search form dialog".split())
OF_ARTICLE = frozenset("article post entry story title".split())  # with these, a header is the article's own
# Words beside a mark that leave its meaning: "ad-slot" is an advert, "search-algorithms" is not a search.
BESIDE_MARK = frozenset(
    "area article bar body bottom box button buttons container content entry form group inner item items left link links "
    "list main module outer page panel post posts primary right secondary section site slot story top unit wrap "
    "wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Names that never stand for the container of a page.
NEVER_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot sponsor sponsored cookie "
    "cookies consent gdpr comment comments commentlist disqus reply replies respond".split())
READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
PROSE_RATIO = 40  # characters per tag from which a line outside the region belongs to the result
RUNNING_RATIO = 15  # characters (without spaces) per tag from which a line is running text
MOST_SHARE = 1 / 2  # of the page's text: a form that holds more is a container
BESIDE_SHARE = 1 / 10  # of its own running text: a named element with no more beside it is the page's container
_OWN_TITLE = frozenset(("header", "masthead"))
_OWN_HEADER = _OWN_TITLE | {"banner"}
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _left_out(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element is boilerplate or hidden by its tag and attributes, without regard to names."""
    if tag in BOILERPLATE or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    return any(name == "hidden" or value and (name == "aria-hidden" and value.lower() == "true"
                                              or name == "style" and _HIDING.search(value)) for name, value in attrs)


def _is_mark(name: str, no_marks: frozenset[str]) -> bool:
    """Whether a whole name stands for boilerplate: marks, and words beside them that add nothing."""
    words = [w for w in _SPLIT.split(_CAMEL.sub(" ", name).lower()) if w and w not in no_marks]
    return not MARKS.isdisjoint(words) and all(w in MARKS or w in BESIDE_MARK for w in words)


def _marked(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """How names mark an element: 3 never content, 2 by class or role, 1 only by the id inside an article, 0 not at all.

    A form is marked by its tag.
    """
    found = 2 if tag == "form" else 0
    if not attrs or tag in HEADINGS or tag in ("html", "body", "main"):
        return found
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            no_marks = frozenset()
            if in_article or not OF_ARTICLE.isdisjoint(_SPLIT.split(_CAMEL.sub(" ", value).lower())):
                no_marks = _OWN_HEADER if tag == "header" else _OWN_TITLE
            for n in value.split():
                if _is_mark(n, no_marks):
                    # Inside an article an id is often the slug of a heading.
                    slug = name == "id" and in_article
                    hard = not (READERS if slug else NEVER_CONTENT).isdisjoint(_SPLIT.split(_CAMEL.sub(" ", n).lower()))
                    found = max(found, 3 if hard else 1 if slug else 2)
    return found


class _Lines(HTMLParser):
    """Lines of a page that are not boilerplate by their tags.

    ``lines``: pieces of text with their containers, number of tags and tag of
    the block. Containers are numbered in order of opening; ``parents`` has the
    one around each, ``marks`` how names mark it. Marked elements are
    containers, too.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[tuple[str, int]], int, str]] = []
        self.parents = [-1]
        self.tags_of = ["html"]
        self.marks = [0]
        self.stack: list[tuple[str, bool, int]] = []  # tag, boilerplate (own or around), container
        self.open_count: dict[str, int] = {}
        self.text: list[tuple[str, int]] = []
        self.tags = 0

    def _outside(self) -> tuple[bool, int]:
        return self.stack[-1][1:] if self.stack else (False, 0)

    def flush(self) -> None:
        if self.text:
            if any(not t.isspace() for t, _ in self.text):
                self.lines.append((self.text, self.tags, self._block()))
                self.tags = 0
            self.text = []

    def _block(self) -> str:
        return next((tag for tag, _, _ in reversed(self.stack) if tag in BLOCKS), "")

    def _space(self) -> None:
        self.text.append((" ", self._outside()[1]))

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS and tag not in ("html", "head", "title") and self.open_count.get("head"):
            self._close("head")
        if tag in BLOCKS:
            if self.open_count.get("p") and tag in NOT_IN_P:
                self._close("p", ("table", "button"))
            self.flush()
        elif tag in CELLS:
            self._space()
        if tag in SIBLINGS:
            for other in SIBLINGS[tag]:
                if self.open_count.get(other):
                    self._close(other, LISTS)
        if tag in VOID:
            return
        out, container = self._outside()
        in_article = bool(self.open_count.get("article") or self.open_count.get("main"))
        mark = _marked(tag, attrs, in_article)
        if mark or tag in REGIONS:
            self.parents.append(container)
            self.tags_of.append(tag)
            self.marks.append(mark)
            container = len(self.parents) - 1
        self.stack.append((tag, out or _left_out(tag, attrs, in_article), container))
        self.open_count[tag] = self.open_count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def _close(self, tag: str, stop_at=()) -> None:
        """Close the innermost ``tag``, and what is open inside it, unless a border is in between."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if any(name in BLOCKS for name, _, _ in self.stack[i:]):
                    self.flush()
                for name, _, _ in self.stack[i:]:
                    self.open_count[name] -= 1
                del self.stack[i:]
                return
            if self.stack[i][0] in stop_at:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if self.open_count.get(tag):
            # The end of inline markup does not close blocks around it.
            self._close(tag, () if tag in BLOCKS or tag in CELLS or tag in BOILERPLATE else BLOCKS)
        if tag in CELLS:
            self._space()

    def handle_data(self, data):
        out, container = self._outside()
        if not out:
            self.text.append((data, container))

    def finish(self) -> None:
        if _unfinished.match(self.rawdata):
            self.rawdata = ""
        self.close()
        self.flush()


# What the parser could not finish starts here: a page cut off inside a tag or a comment ends before it.
_unfinished = re.compile(r"<(?:[a-zA-Z/!?]|\Z)")


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Ratios after a Gaussian filter; at the ends the weights inside count alone."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    if len(ratios) == 1:
        return ratios
    full = np.convolve(ratios, kernel)[reach:reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which smoothed ratios belong to the upper of two clusters."""
    low, high = ratios.min(), ratios.max()
    if high - low < 1e-9:
        return np.ones(len(ratios), dtype=bool)
    threshold = (low + high) / 2
    for _ in range(20):  # two means in one dimension, as a threshold between them
        upper = ratios >= threshold
        if upper.all() or not upper.any():
            break
        new = (ratios[upper].mean() + ratios[~upper].mean()) / 2
        if abs(new - threshold) < 1e-9:
            break
        threshold = new
    return ratios >= threshold


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in order, one per line; empty if there is none."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.finish()
    lines = _unmarked(page)
    if not lines:
        return ""
    lengths = np.array([len(t) for t, _, _, _ in lines], dtype=float)
    tags = np.array([max(n, 1) for _, n, _, _ in lines], dtype=float)
    # On a log scale, one very long line does not push the others into the lower cluster.
    content = content_lines(np.log1p(smoothed(lengths / tags, SMOOTHING)))
    inside = _inside(page, lines, lengths * content, lengths / tags >= PROSE_RATIO)
    return "\n".join(t for t, _, c, _ in lines if inside[c])


def _unmarked(page: _Lines) -> list[tuple[str, int, int, str]]:
    """Lines without the text of boilerplate by name: text, number of tags, container and tag of the block."""
    out = _marked_out(page) if any(page.marks) else None
    lines, carried = [], 0
    for pieces, tags, block in page.lines:
        if out is not None:
            pieces = [p for p in pieces if not out[p[1]]]
        text = " ".join("".join([t for t, _ in pieces]).split())
        if not text:
            carried += tags
            continue
        around = {c for t, c in pieces if not t.isspace()}
        while len(around) > 1:  # the smallest container around all pieces; parents come before their children
            last = max(around)
            around.remove(last)
            around.add(page.parents[last])
        lines.append((text, tags + carried, around.pop(), block))
        carried = 0
    return lines


def _marked_out(page: _Lines) -> list[bool]:
    """Which containers are boilerplate by name, or lie in one that is."""
    n = len(page.parents)
    chars, tags, prose, own_prose, holds_article = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    nearest = [-1] * n  # marked container around each, itself included
    for c in range(1, n):
        nearest[c] = c if page.marks[c] > 1 else nearest[page.parents[c]]
    beside = 0  # running text that lies in no marked container, or only in such that stay
    for pieces, count, _ in page.lines:
        length = 0
        for text, c in pieces:
            own = len("".join(text.split()))
            chars[c] += own
            length += own
        first = next(c for t, c in pieces if not t.isspace())
        tags[first] += count
        if length >= RUNNING_RATIO * max(count, 1):
            prose[first] += length
            if nearest[first] < 0:
                beside += length
            else:
                own_prose[nearest[first]] += length
    for c in range(n - 1, 0, -1):
        up = page.parents[c]
        chars[up] += chars[c]
        tags[up] += tags[c]
        prose[up] += prose[c]
        # A comment or a teaser may be an article by its tag; its name tells.
        holds_article[up] |= holds_article[c] or page.tags_of[c] in ("main", "article") and not page.marks[c]
    out = [False] * n
    for c in range(1, n):
        out[c] = out[page.parents[c]]
        if out[c] or not page.marks[c]:
            continue
        tag, mark = page.tags_of[c], page.marks[c]
        if holds_article[c]:
            out[c] = False
        elif tag == "article":
            out[c] = mark == 3 and beside > 0
        elif mark == 1:  # an id in an article: only if it holds little text per tag
            rest = (chars[0] - chars[c]) / max(tags[0] - tags[c], 1)
            out[c] = chars[c] <= MOST_SHARE * chars[0] and chars[c] / max(tags[c], 1) < rest / 2
        elif mark == 3 or not prose[c]:
            out[c] = True
        elif tag == "form":
            out[c] = holds_article[0] or chars[c] <= MOST_SHARE * chars[0] or beside > prose[c] / 3
        else:
            out[c] = beside > BESIDE_SHARE * prose[c]
        if not out[c]:
            beside += own_prose[c]
    return out


def _inside(page: _Lines, lines: list[tuple[str, int, int, str]], weights: np.ndarray,
            prose: np.ndarray) -> list[bool]:
    """Which containers have lines of the result directly in them."""
    n = len(page.parents)
    own, filled = np.zeros(n), [False] * n  # content and any text, in a container and below
    for (_, _, container, _), w in zip(lines, weights):
        own[container] += w
        filled[container] = True
    for c in range(n - 1, 0, -1):  # parents come before their children
        own[page.parents[c]] += own[c]
        filled[page.parents[c]] |= filled[c]
    for c in range(n):
        if page.tags_of[c] == "article" and own[c] >= own[0] / 2:
            return _below(page.parents, c)  # never smaller than an article, and not entered further
    sections = [0] * n
    for c in range(1, n):
        sections[page.parents[c]] += page.tags_of[c] == "section" and filled[c]
    region = 0
    for c in range(1, n):
        if page.parents[c] != region or page.tags_of[c] not in REGIONS or own[c] < own[0]:
            continue
        if page.tags_of[c] == "section" and sections[region] > 1:
            break  # one of several sections
        region = c
        if page.tags_of[c] == "main":
            break
    inside = _below(page.parents, region)
    around, c = set(), region
    while c > 0:
        if page.tags_of[c] == "main":
            return inside
        c = page.parents[c]
        around.add(c)
    for (_, _, c, block), long in zip(lines, prose):
        if long or block == "h1" or c in around and (block in HEADINGS or block == "p"):
            inside[c] = True
    return inside


def _below(parents: list[int], region: int) -> list[bool]:
    inside = [False] * len(parents)
    inside[region] = True
    for c in range(region + 1, len(parents)):
        inside[c] = inside[parents[c]]
    return inside


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page.

    Returns the id, the url, ``text`` (empty if the page is null, empty or has no
    content) and ``n_chars``, its code points. Broken markup, unclosed elements
    and pages cut off anywhere give the text that can be read. Repeated rows and
    null ids or urls pass through, other columns are not read. One pass, no shuffle.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def one(key, url, html):
        text = main_text(html)
        return key, url, text, len(text)

    return map_rows(pages.select(F.col(id_col), F.col(url_col), F.col(html_col)),
                    f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars bigint",
                    [id_col, url_col, "text", "n_chars"], lambda: one)
