"""Main text of a page: parser events, text-to-tag ratio per line, smoothing, clustering."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

#: Elements that start a new line, and elements that never hold main text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl
    dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu
    nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul""".split())
SKIPPED = frozenset("""aside button canvas datalist dialog footer form head header iframe input label
    math menu nav noframes noscript object script select style svg template textarea title""".split())
VOID = frozenset("""area base br col embed hr img input link meta param source track wbr""".split())
#: Elements that an open p ends at, and elements that end an open one of their kind.
ENDS_P = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr option optgroup legend".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
            "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Words of class, id or role that mark what surrounds an article.
SURROUNDINGS = frozenset("""ad ads advert advertisement advertising banner breadcrumb breadcrumbs
    comment comments commentlist complementary contentinfo cookie cookies consent disqus dropdown
    footer form gdpr header masthead menu menubar modal nav navbar navigation newsletter notice
    notices notification pagination popup promo promoted promotion recommended related replies reply
    respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser
    toolbar topbar widget""".split())
#: Of these, words of what holds articles of its own beside the main one.
REPEATING = frozenset("""comment comments commentlist disqus recommended related replies reply respond
    teaser""".split())
#: Text in a marked element counts for a tenth of other text in deciding whether it is the page itself.
PENALTY = 10
#: Words that mark a text block in an article; its other words and its id describe what it says.
ADVERTS = frozenset("""ad ads advert advertisement advertising promo promoted promotion sponsor
    sponsored""".split())
#: Elements whose id is often made from their text, and of these the ones that hold running text.
NAMED_BY_TEXT = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
RUNNING_TEXT = NAMED_BY_TEXT - frozenset("li td th".split())
#: Elements that name the main text themselves.
MAIN = frozenset(("article", "main"))
#: Elements that are text blocks or rows of them, never the region; a cell is one if it is one line.
TEXT_BLOCKS = frozenset("""address blockquote caption dd dl dt figcaption h1 h2 h3 h4 h5 h6 legend li
    menu ol option p pre summary table tbody tfoot thead tr ul""".split())
CELLS = frozenset(("td", "th"))
#: Characters that a line counts for at most, so that one long paragraph does not hide short ones.
LINE_CHARS = 200
#: Lines, mostly links, between content and a cluster that is clearly apart from it.
GAP_LINES = 3
FEED_CHARS = 65_536
SPACE = re.compile(r"\s+")


@dataclass
class Marked:
    """What is in a marked element, or in none: characters outside links."""
    repeating: bool = False
    in_main: bool = False
    #: number of the marked element around it
    around: int = 0
    #: characters in it, and those of them in an article or main inside it
    chars: int = 0
    main_chars: int = 0
    #: those in no marked element inside it, of these the ones in any article or main, and whether there is text
    own_chars: int = 0
    own_main: int = 0
    named: bool = False


@dataclass
class Line:
    text: list[str] = field(default_factory=list)
    tags: int = 0
    link_chars: int = 0
    #: number of the block element that it is in
    inside: int = 0


@dataclass
class Open:
    """An open element."""
    tag: str
    skipped: bool
    #: skipped whatever the marks say
    hidden: bool
    link: bool
    #: numbers of the nearest block element, marked element, and article or main down to it
    block: int
    mark: int
    main: int


NOWHERE = Open("", False, False, False, 0, 0, 0)


class Lines(HTMLParser):
    """Collects one line per run of text between block boundaries; skipped elements give none.
    The marks of elements with the numbers ``exempt`` do not count.

    Elements know their nearest block, mark and article by number, and open elements of a tag are
    a list of places, so that the work is linear in the page, however deep it nests.
    """

    def __init__(self, exempt: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.exempt = exempt
        self.lines = [Line()]
        self.open: list[Open] = []
        #: places in ``open`` by tag, of blocks, and of elements that a p ends at
        self.at: dict[str, list[int]] = {}
        #: number 0 is what no marked element holds
        self.marked: dict[int, Marked] = {0: Marked()}
        #: by number, of block elements: tag, the block around, the outermost article or main, the
        #: outermost article, the depth
        self.kinds: list[str] = [""]
        self.parents: list[int] = [0]
        self.tops: list[int] = [0]
        self.articles: list[int] = [0]
        self.depths: list[int] = [0]
        #: the mark around each article or main
        self.mark_around: dict[int, int] = {}

    def _last(self) -> Open:
        return self.open[-1] if self.open else NOWHERE

    def _nearest(self, key: str) -> int:
        places = self.at.get(key)
        return places[-1] if places else -1

    def _break(self) -> None:
        if self.lines[-1].text:
            self.lines.append(Line())
        self.lines[-1].inside = 0

    def _groups(self, tag: str) -> list[str]:
        return [tag, *(["#block"] if tag in BLOCKS else []), *(["#ends p"] if tag in ENDS_P else [])]

    def _close(self, at: int) -> None:
        while len(self.open) > at:
            for key in self._groups(self.open.pop().tag):
                self.at[key].pop()

    def _marks(self, tag: str, attrs, in_main: bool) -> frozenset[str]:
        names = ("class", "role") if tag in NAMED_BY_TEXT else ("class", "id", "role")
        marks = " ".join(v for k, v in attrs if k in names and v)
        words = SURROUNDINGS.intersection(re.split(r"[^a-z0-9]+", marks.lower())) if marks else frozenset()
        if in_main and tag in RUNNING_TEXT:
            return words & ADVERTS
        return frozenset() if in_main and words == {"header"} else words

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._end_nearest("p", ("table", "td", "th", "button", "#ends p"))
        if tag in SIBLINGS:
            self._end_nearest(tag, SIBLINGS[tag])
        if tag in ("td", "th"):
            self._end_nearest("th" if tag == "td" else "td", SIBLINGS[tag])
        if tag in ("dt", "dd"):
            self._end_nearest("dd" if tag == "dt" else "dt", ("dl",))
        if tag in BLOCKS:
            self._break()
        around = self._last()
        if not around.skipped:
            self.lines[-1].tags += 1
            if tag == "br":
                self.handle_data(" ")
        if tag in VOID:
            return
        in_main = around.main > 0
        number = len(self.kinds)
        self.kinds.append(tag)
        self.parents.append(around.block)
        top, article = self.tops[around.block], self.articles[around.block]
        self.tops.append(top or (number if tag in MAIN else 0))
        self.articles.append(article or (number if tag == "article" else 0))
        self.depths.append(self.depths[around.block] + 1)
        hidden = (around.hidden or (tag in SKIPPED and not (tag == "header" and in_main))  # an article's own stays
                  or any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs))
        skipped, mark = hidden or around.skipped, around.mark
        if not hidden and tag not in ("html", "body", *MAIN):
            words = self._marks(tag, attrs, in_main)
            if words:
                self.marked[number] = Marked(bool(REPEATING & words), in_main, mark)
                mark, skipped = number, skipped or number not in self.exempt
        if tag in MAIN:
            self.mark_around[number] = mark
        for key in self._groups(tag):
            self.at.setdefault(key, []).append(len(self.open))
        self.open.append(Open(tag, skipped, hidden, tag == "a" or around.link,
                              number if tag in BLOCKS else around.block, mark,
                              number if tag in MAIN else around.main))

    def _end_nearest(self, tag: str, fences: tuple[str, ...]) -> None:
        place = self._nearest(tag)
        if place >= 0 and all(self._nearest(f) <= place for f in fences):
            self._break()
            self._close(place)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._break()
        elif not self._last().skipped:
            self.lines[-1].tags += 1
        place = self._nearest(tag)
        # an inline end tag does not reach out of its block
        if place >= 0 and (tag in BLOCKS or tag in SKIPPED or self._nearest("#block") < place):
            self._close(place)

    def _count(self, data: str) -> None:
        e = self._last()
        chars = len(data.strip())
        if e.hidden or not chars:
            return
        m = self.marked[e.mark]
        m.named = m.named or e.main > 0
        if e.link:
            return
        m.chars += chars
        m.own_chars += chars
        if e.main:
            m.own_main += chars
            self.marked[self.mark_around[e.main]].main_chars += chars

    def wrongly_marked(self) -> frozenset[int]:
        """Marked elements that hold the article, or nearly all text of the page or of its article.

        An element that is found so counts as unmarked, and the marked ones in it are judged next.
        """
        inner: dict[int, list[int]] = {}
        for n in sorted(self.marked, reverse=True):  # inner ones have greater numbers
            m = self.marked[n]
            if n:
                self.marked[m.around].chars += m.chars
                self.marked[m.around].main_chars += m.main_chars
                inner.setdefault(m.around, []).append(n)
        wrong: set[int] = set()
        judged = set(inner.get(0, ()))
        plain, main, named = self.marked[0].own_chars, self.marked[0].own_main, self.marked[0].named
        while judged:
            marked = {n: self.marked[n] for n in judged}
            hold = {n for n, m in marked.items()
                    if m.main_chars and (main == 0 or (not m.repeating and m.main_chars >= main))}
            found = {n for n in hold if not marked[n].repeating} or hold
            if not found:
                rest = [(m.chars, n) for n, m in marked.items() if m.in_main or not named]
                besides = main if named else plain
                most = max(((c, n) for c, n in rest if not marked[n].repeating or besides == 0), default=(0, 0))
                found = {most[1]} if most[0] > PENALTY * besides else set()
            if not found:
                break
            for n in found:
                m = self.marked[n]
                plain, main, named = plain + m.own_chars, main + m.own_main, named or m.named
                judged.update(inner.get(n, ()))
            judged -= found
            wrong |= found
        return frozenset(wrong)

    def handle_data(self, data):
        self._count(data)
        line, e = self.lines[-1], self._last()
        if e.skipped or not data or (not line.text and not data.strip()):
            return
        line.inside = line.inside or e.block
        line.text.append(data)
        if e.link:
            line.link_chars += len(data.strip())


def smooth(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian average over neighbouring lines."""
    reach = max(1, math.ceil(2 * sigma))
    weight = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - reach), min(len(values), i + reach + 1))
        total = sum(weight[abs(i - j)] for j in near)
        out.append(sum(weight[abs(i - j)] * values[j] for j in near) / total)
    return out


def read(html: str, exempt: frozenset[int] = frozenset()) -> Lines:
    parser = Lines(exempt)
    for a in range(0, len(html), FEED_CHARS):
        parser.feed(html[a:a + FEED_CHARS])
    parser.close()
    return parser


def parsed(html: str) -> Lines:
    """The page's lines; it is parsed a second time where marks hid the page itself."""
    parser = read(html)
    wrong = parser.wrongly_marked()
    return read(html, wrong) if wrong else parser


def clusters(content: list[int], found: list[tuple[str, Line]], own: list[int]) -> list[list[int]]:
    """Content lines, cut where GAP_LINES or more others lie between that are mostly links."""
    out = [content[:1]]
    for a, b in zip(content, content[1:]):
        between = range(a + 1, b)
        chars = sum(len(found[i][0]) for i in between)
        if len(between) >= GAP_LINES and 2 * sum(own[i] for i in between) < chars:
            out.append([])
        out[-1].append(b)
    return out


def region_of(inside: list[int], page: Lines) -> int:
    """The deepest element around all the lines that is no text block; 0 is the whole page."""
    shared = inside[0]
    for n in inside[1:]:
        while shared != n:
            if page.depths[shared] >= page.depths[n]:
                shared = page.parents[shared]
            else:
                n = page.parents[n]
    while shared and (page.kinds[shared] in TEXT_BLOCKS or (page.kinds[shared] in CELLS and len(inside) == 1)):
        shared = page.parents[shared]
    return shared


def descendants(region: int, page: Lines) -> list[bool]:
    """By number, whether an element is the region or in it; parents have smaller numbers."""
    within = [region == 0]
    for n in range(1, len(page.kinds)):
        within.append(n == region or within[page.parents[n]])
    return within


def beside_the_story(found: list[tuple[str, Line]], own: list[int], page: Lines) -> set[int]:
    """Articles in a main of which another article holds more than half of the text."""
    chars: dict[int, dict[int, int]] = {}
    for n, (_, line) in zip(own, found):
        top, article = page.tops[line.inside], page.articles[line.inside]
        if top and page.kinds[top] == "main":
            held = chars.setdefault(top, {})
            held[article] = held.get(article, 0) + n
    out: set[int] = set()
    for held in chars.values():
        most, story = max((n, a) for a, n in held.items())
        if story and 2 * most > sum(held.values()):
            out |= set(held) - {0, story}
    return out


def main_text(html: str) -> str:
    """Blocks of the content region, one per line.

    Lines whose smoothed text-to-tag ratio reaches the threshold (half the mean, in which link
    text does not count and a long line counts for LINE_CHARS) are content, and lines that reach it
    by themselves, such as a paragraph between links.  An article or main
    element that holds content is the region, without smaller articles beside the story in a main.
    Without one it is the smallest container of all content; a cluster clearly apart belongs to it
    if one of its lines reaches the threshold by itself, without its neighbours, and the links
    between clusters do not.  A text block is no container.  All other lines of the region stay,
    short ones too.
    """
    page = parsed(html)
    found = []
    for line in page.lines:
        text = SPACE.sub(" ", "".join(line.text)).strip()
        if text:
            found.append((text, line))
    if not found:
        return ""
    own = [max(0, len(t) - line.link_chars) for t, line in found]
    single = [min(LINE_CHARS, n / max(1, line.tags)) for n, (_, line) in zip(own, found)]
    ratio = smooth(single)
    threshold = sum(ratio) / len(ratio) / 2
    content = [i for i, r in enumerate(ratio) if max(r, single[i]) >= threshold]
    tops = [page.tops[line.inside] for _, line in found]
    if any(tops):
        # what is around a held element is held, so the outermost one decides
        held = {tops[i] for i in content if own[i]} - {0} or set(tops) - {0}
        other = beside_the_story(found, own, page)
        return "\n".join(t for (t, line), top in zip(found, tops)
                         if top in held and page.articles[line.inside] not in other)
    # a line of links beside long text is content by smoothing only
    content = [i for i in content if 2 * own[i] >= len(found[i][0])] or content
    groups = clusters(content, found, own)
    groups = [g for g in groups if any(single[i] >= threshold for i in g)] or groups
    between = {i for a, b in zip(groups, groups[1:]) for i in range(a[-1] + 1, b[0])
               if 2 * own[i] < len(found[i][0])}
    within = descendants(region_of([found[i][1].inside for g in groups for i in g], page), page)
    return "\n".join(t for i, (t, line) in enumerate(found) if within[line.inside] and i not in between)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the ``carry`` columns, text.  NULL or empty html, and html without text, give ''."""
    return map_texts(pages, id_col, html_col, "text string",
                     lambda batch: [pa.array([main_text(h) for h in batch], pa.string())], 4_000_000, carry)
