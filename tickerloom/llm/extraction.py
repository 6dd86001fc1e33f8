"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser turns a page into lines, one per block of
text. A line's ratio is its characters outside links per tag met on it. Ratios are
smoothed with a Gaussian over the neighbouring lines, and lines whose smoothed ratio
exceeds a share of the page's mean form the content clusters. A cluster selects the
container it lies in (the nearest article, main or other sectioning element), and
all lines of selected containers are the text: a short paragraph or a heading among
long ones is kept. On a page without article or main the containers beside a selected
one, in the same parent, are selected too unless most of their text is links: an
article may be one container a section, of any length. Where most of the selected text of
a parent is in containers with paragraphs or headings, those without are left out: a bare
line beside sections of paragraphs is a footer. Inside
what is selected a smaller container that is mostly links, on two lines at least or as an
article of its own, is a list of other pages and left out.

Elements that say themselves that they are not the article (nav, header outside an
article, footer, aside, form, script and the like, or a class, id or role naming a
menu, sidebar, advert, notice or comments) give no lines. A name is only a hint: state
words (has-sidebar) and headers of an entry (post-header) are no names of that kind, and
a named element that has the page's main is kept, and where no article is shown, one
that has most of the text outside links, alone or with others that have articles (not
counting comments, adverts and the like, which are never kept so). A form counts as named
so: one around the whole page hides nothing but its own fields. Pages may be cut off
anywhere, also inside a tag, and elements left open; a void or unclosed inline element does no harm,
for only blocks and containers are tracked. A head ends where the body begins, by a
tag or by what a head cannot hold. A nav, header, form or the like that is never closed
hides nothing from the first article or main in it on, unless the page is cut off and
has an article before it.

Null, empty and tag-only pages give an empty string. Every row is its own result, so
repeated rows are repeated; other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import rows

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main "
    "nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article main section body div html td blockquote".split())
SECTIONS = frozenset("article main section div body html td".split())
SPOKEN = frozenset("p h1 h2 h3 h4 h5 h6 li dd blockquote pre table".split())
HIDDEN = frozenset(
    "script style noscript template head title iframe object svg math canvas nav aside footer "
    "form button select option textarea input label dialog menu audio video map".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
#: What a head may hold; any other element ends it.
IN_HEAD = frozenset("html head base link meta title script style noscript template".split())
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement adbox banner sponsor sponsored promo promotion cookie "
    "cookies consent notice alert popup modal overlay newsletter subscribe signup sidebar side "
    "aside rail widget nav navbar navigation navmenu menu menubar breadcrumb breadcrumbs footer "
    "header masthead topbar toolbar social share sharing related recommended comment comments "
    "commentlist discussion disqus respond reply replies login search searchbox copyright legal pagination "
    "pager skip complementary contentinfo banner form gdpr paywall teaser tags".split())
#: Marks of what is long on some pages and never holds the article for its length alone.
OTHERS = frozenset(
    "ad ads advert adverts advertisement adbox sponsor sponsored promo promotion cookie cookies "
    "consent newsletter comment comments commentlist discussion disqus respond reply replies related "
    "recommended gdpr".split())
#: Words before a mark that make it a state of a layout.
STATES = frozenset("has with no without".split())
CONTENT = frozenset("article content main post entry story body text".split())
NAMES = re.compile(r"[A-Za-z]+")
WHITE = re.compile(r"\s+")


def _names(value: str) -> list[str]:
    """Lower-cased words of an attribute; a capital starts a new word."""
    return [w.lower() for w in NAMES.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value))]


def _marks(words: list[str]) -> set[str]:
    """The marks among the words of one name, less states and headers of an entry."""
    return {w for before, w in zip(["", *words], words, strict=False) if w in MARKS
            and before not in STATES and not (w == "header" and before in CONTENT)}


def _unseen(attrs: list[tuple[str, str | None]]) -> bool:
    for name, value in attrs:
        if name in ("hidden",) or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
    """Marks in the element's names."""
    if tag in ("html", "body", "main", "article"):
        return set()
    return {w for name, value in attrs if name in ("class", "id", "role") and value
            for token in value.split() for w in _marks(_names(token))}


@dataclass
class Hider:
    """An element that hides its text, and the first piece of an article in it."""

    outer: int                # the hider around it, or -1
    by_tag: bool
    first_piece: int
    marks: set[str]           # of an element that only its names hide
    article_piece: int | None = None
    has_main: bool = False
    closed: bool = False


class PageLines(HTMLParser):
    """Lines of a page: (text, ratio, container number), once it is finished."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, float, int]] = []
        self.linked: list[int] = []                   # characters in links of each line
        self.spoken: list[bool] = []                  # whether it is of a paragraph or the like
        self.parents: list[int] = [-1]
        self.kinds: list[str] = [""]
        self._open: list[tuple[str, int, int]] = []   # tag, its container, its hider or -1
        self._hiders: list[Hider] = []
        self._hider = -1                              # the innermost open one
        self._shown_article: int | None = None        # first piece of an article not hidden
        self._ended = False                           # the body's or page's end tag was met
        self._article = 0
        self._container = 0
        self._pieces: list[tuple[str, int, int]] = []   # text, characters in links, hider
        # of each line the end of its pieces, tags, container, whether it is spoken
        self._raw: list[tuple[int, int, int, bool]] = []
        self._tags, self._link = 0, False

    def _end_line(self) -> None:
        if len(self._pieces) > (self._raw[-1][0] if self._raw else 0):
            spoken = any(t in SPOKEN and c == self._container for t, c, _ in self._open)
            self._raw.append((len(self._pieces), self._tags, self._container, spoken))
        self._tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_line()
        self._tags += 1
        if tag not in IN_HEAD:
            self._end_head(tag)
        if tag in ("article", "main"):
            self._begin_article(tag)
        if tag == "a":
            self._link = True
        if tag in VOID:
            return
        if tag in BLOCKS and tag != "body" and tag not in SECTIONS:
            self._close_implied(tag)
        by_tag = tag in HIDDEN or (tag == "header" and not self._article)
        surely = by_tag or _unseen(attrs)
        marks = set() if surely and tag != "form" else _marked(tag, attrs)
        if tag == "form" and not _unseen(attrs):
            marks.add("form")
        hides = surely or bool(marks)
        if tag in BLOCKS or hides:
            self._open.append((tag, self._container, len(self._hiders) if hides else -1))
            if hides:
                self._hiders.append(Hider(self._hider, by_tag, len(self._pieces), marks))
                self._hider = len(self._hiders) - 1
            self._article += tag == "article"
            if tag in SECTIONS:
                self.parents.append(self._container)
                self.kinds.append(tag)
                self._container = len(self.parents) - 1

    def _end_head(self, tag: str) -> None:
        """A head without end tag ends at the body or at what a head cannot hold."""
        tags = [t for t, _, _ in self._open]
        if "head" in tags:
            at = tags.index("head")
            if tag == "body" or not {"noscript", "template"}.intersection(tags[at:]):
                while len(self._open) > at:
                    self._pop()

    def _begin_article(self, tag: str) -> None:
        if self._hider < 0 and self._shown_article is None:
            self._shown_article = len(self._pieces)
        around = self._hider
        while around >= 0:
            if self._hiders[around].article_piece is None:
                self._hiders[around].article_piece = len(self._pieces)
            self._hiders[around].has_main |= tag == "main"
            around = self._hiders[around].outer

    def _close_implied(self, tag: str) -> None:
        """A paragraph, item or cell ends where the next of its kind begins."""
        if self._open and self._open[-1][0] == "p" or (
                self._open and self._open[-1][0] == tag and tag in ("li", "dt", "dd", "tr")):
            self._pop()

    def _pop(self) -> None:
        tag, container, hider = self._open.pop()
        if hider >= 0:
            self._hider = self._hiders[hider].outer
        self._article -= tag == "article"
        self._container = container

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        self._tags += 1
        if tag == "a":
            self._link = False
        self._ended |= tag in ("body", "html")
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                if self._open[i][2] >= 0:
                    self._hiders[self._open[i][2]].closed = True
                while len(self._open) > i:
                    self._pop()
                return
            if self._open[i][0] in ("article", "main") and tag in ("p", "div", "li", "span"):
                return

    def handle_data(self, data: str) -> None:
        if self._open and self._open[-1][0] in RAW:
            return
        if self._open and self._open[-1][0] == "head" and data.strip():
            self._pop()
        self._pieces.append((data, len(data.strip()) if self._link else 0, self._hider))

    def finish(self) -> None:
        self.close()
        self._end_line()
        until = self._judged([self._hides_until(h) for h in self._hiders])
        begin = 0
        for end, tags, container, spoken in self._raw:
            shown = [self._pieces[k] for k in range(begin, end)
                     if not self._is_hidden(k, until)]
            begin = end
            text = WHITE.sub(" ", "".join(t for t, _, _ in shown)).strip()
            if text:
                linked = sum(n for _, n, _ in shown)
                self.linked.append(linked)
                self.spoken.append(spoken)
                self.lines.append((text, max(len(text) - linked, 0) / max(tags, 1), container))

    def _hides_until(self, hider: Hider) -> float:
        """The piece from which on the element hides nothing."""
        if hider.closed or not hider.by_tag or hider.article_piece is None:
            return math.inf
        cut_off = not self._ended and self._shown_article is not None and (
            self._shown_article < hider.first_piece)
        return math.inf if cut_off else hider.article_piece

    def _judged(self, until: list[float]) -> list[float]:
        """`until`, with 0 for marked elements that hold the article."""
        marked = [i for i, h in enumerate(self._hiders) if h.marks]
        if not marked:
            return until
        for i in marked:
            if self._hiders[i].has_main:
                until[i] = 0
        # articles that nothing else hides
        sure = [0 if h.marks else u for h, u in zip(self._hiders, until, strict=True)]
        shown = self._shown_article is not None or any(
            h.article_piece is not None and not self._hides(i, h.article_piece, until)
            for i, h in enumerate(self._hiders))
        if shown:
            return until
        wrappers = {i for i in marked if not self._hiders[i].marks & OTHERS}
        held = {i for i in wrappers if self._hiders[i].article_piece is not None
                and not self._hides(i, self._hiders[i].article_piece, sure)}
        total, in_held, own = 0, 0, dict.fromkeys(wrappers, 0)
        for k, (text, linked, hider) in enumerate(self._pieces):
            around = set()
            while hider >= 0 and k >= sure[hider]:
                around.add(hider)
                hider = self._hiders[hider].outer
            if hider >= 0 or any(self._hiders[i].marks & OTHERS for i in around):
                continue
            size = max(len(text.strip()) - linked, 0)
            total += size
            in_held += size * bool(around & held)
            for i in around & wrappers:
                own[i] += size
        for i in wrappers:
            if 2 * own[i] > total or i in held and 2 * in_held > total:
                until[i] = 0
        return until

    def _is_hidden(self, piece: int, until: list[float]) -> bool:
        return self._hides(self._pieces[piece][2], piece, until)

    def _hides(self, hider: int, piece: int, until: list[float]) -> bool:
        """Whether the element or one around it hides the piece."""
        while hider >= 0:
            if piece < until[hider]:
                return True
            hider = self._hiders[hider].outer
        return False


def smoothed(ratios: list[float], sigma: float) -> list[float]:
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        lo, hi = max(0, i - reach), min(len(ratios), i + reach + 1)
        own = weights[lo - i + reach:hi - i + reach]
        out.append(sum(w * r for w, r in zip(own, ratios[lo:hi], strict=True)) / sum(own))
    return out


def _whole_tags(html: str) -> str:
    """The page less a tag at its end that was cut off."""
    at = html.rfind("<")
    cut = at > html.rfind(">") and re.match(r"[A-Za-z/!?]", html[at + 1:at + 2])
    return html[:at] if cut else html


def extract(html: str | None, sigma: float = 1.0, share: float = 0.5) -> str:
    """The main text of one page."""
    page = PageLines()
    page.feed(_whole_tags(html or ""))
    page.finish()
    if not page.lines:
        return ""
    values = smoothed([r for _, r, _ in page.lines], sigma)
    threshold = share * sum(values) / len(values)
    chosen = {c for (_, _, c), v in zip(page.lines, values, strict=True) if v >= threshold}
    articles = {c for c in chosen if _inside(page, c, ("article", "main")) >= 0}
    if articles:
        roots = {_inside(page, c, ("article", "main")) for c in articles}
    else:
        roots = _sections(page, chosen)
    lists = _lists(page, roots)
    return " ".join(text for text, _, c in page.lines
                    if _under(page, c, roots) and not _under(page, c, lists))


def _sums(page: PageLines, values: list[int]) -> list[int]:
    """The values of lines, added up for each container with all that it holds."""
    sums = [0] * len(page.parents)
    for (_, _, c), value in zip(page.lines, values, strict=True):
        while c >= 0:
            sums[c] += value
            c = page.parents[c]
    return sums


def _lists(page: PageLines, roots: set[int]) -> set[int]:
    """Containers inside a root, with less than half of its text, that are mostly links."""
    if not any(page.linked):
        return set()
    size = _sums(page, [len(text) for text, _, _ in page.lines])
    linked = _sums(page, page.linked)
    links = _sums(page, [int(n > 0) for n in page.linked])
    found = set()
    for c, kind in enumerate(page.kinds):
        if kind not in ("div", "section", "article") or c in roots or 2 * linked[c] <= size[c]:
            continue
        if links[c] < 2 and kind != "article":
            continue
        around = page.parents[c]
        while around >= 0 and around not in roots:
            around = page.parents[around]
        if around >= 0 and 2 * size[c] < size[around]:
            found.add(c)
    return found


def _sections(page: PageLines, chosen: set[int]) -> set[int]:
    """The chosen containers and those beside them with most text outside links; all with
    paragraphs where these hold most of the chosen text of one parent."""
    plain = _sums(page, [max(len(text) - n, 0) for (text, _, _), n in
                         zip(page.lines, page.linked, strict=True)])
    linked, spoken = _sums(page, page.linked), _sums(page, [int(x) for x in page.spoken])
    lead = dict.fromkeys((page.parents[c] for c in chosen), 0)
    for c in chosen:
        lead[page.parents[c]] += plain[c] if spoken[c] else -plain[c]
    return {c for c, parent in enumerate(page.parents) if parent in lead
            and (c in chosen or c and plain[c] > linked[c]) and (spoken[c] or lead[parent] <= 0)}


def _inside(page: PageLines, container: int, kinds: tuple[str, ...]) -> int:
    """The outermost container of these kinds around `container`, or -1."""
    found = -1
    while container >= 0:
        if page.kinds[container] in kinds:
            found = container
        container = page.parents[container]
    return found


def _under(page: PageLines, container: int, roots: set[int]) -> bool:
    while container >= 0:
        if container in roots:
            return True
        container = page.parents[container]
    return False


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h) for (h,) in rows(iter([batch]), "html")]
            yield pa.record_batch({
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long")
