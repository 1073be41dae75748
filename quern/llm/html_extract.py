"""Main text of HTML pages from the standard library parser's event stream.

The events are cut into lines, one for each block of text. Lines inside elements that
never hold the article (menus, footers, forms, adverts ...) are set aside by element
name, role, or class and id words; inside an article or main element only by names that say nothing else. Each other line has a text-to-tag ratio; the ratios are
smoothed with a Gaussian over neighbouring lines and cut into two clusters at the
threshold between their means. The content region is all outermost article and main elements, if
they hold most text of the high cluster, else the innermost element that holds
all of that text; every line inside it is kept, so short paragraphs of the article stay, and so is a top heading before it.

Reader comments are known by structure: an article inside an article that has paragraphs of its own, and
what follows a heading that says so, to the end of the element that the heading stands in."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose content is never the article's.
NEVER = frozenset(
    "head title script style noscript template nav footer aside button select option textarea dialog menu iframe object svg canvas audio video map datalist fieldset".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
#: Words of class or id attributes that mark an element as something beside the article.
BESIDE_WORDS = (
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer bottombar sidebar aside rail ad ads advert advertisement adverts adsense sponsor sponsored "
    "promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay subscribe subscription newsletter signup login share sharing social "
    "related recommended recommendations comment comments commentlist disqus replies reply respond response responses feedback kommentare commentaires comentarios widget toolbar search pagination pager copyright legal disclaimer skip hidden"
).split()
BESIDE = re.compile(r"(?:^|[^a-z])(?:" + "|".join(BESIDE_WORDS) + r")(?:$|[^a-z])")
#: Words that may stand beside those in the name of a part of the page; other words make it the name of something else.
PLACE_WORDS = frozenset(
    "site page main top bottom left right box block wrapper wrap container list section area bar link links form inner outer button buttons item items user users reader readers post "
    "group panel unit slot holder col column primary secondary global local sub mobile desktop sticky fixed small large title label inline row icon icons image banner header media".split()
)
#: Elements that hold parts of a page; inside the article no other element is one by its id.
HOLDERS = frozenset("div section ul ol dl form table details figure center".split())
#: Those that mark the site's head, unless they are inside the article.
HEAD = re.compile(r"(?:^|[^a-z])(?:header|masthead|topbar|banner)(?:$|[^a-z])")
#: A name of one of these and one of those is that of a notice, whatever else it says.
NOTICE = re.compile(r"cookie|consent|gdpr")
NOTICE_SHAPE = re.compile(r"dialog|banner|notice|popup|modal|overlay|alert|wall|bar\b|bot")
#: Headings of reader comments, in the languages of the pages.
COMMENTS = re.compile(
    r"(?i)(?:\d+\s+)?(?:(?:reader |user )?comments?|replies|\d+ responses|kommentare?|\d+ antworten|(?:\d+ )?commentaires?|\d+ réponses|comentarios?|\d+ respuestas"
    r"|(?:leave|add|post|write) a (?:reply|comment)|schreibe? einen kommentar|laisser un commentaire|deja un comentario)(?:\s*\(\d+\))?\s*[:.]?"
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements a start tag closes when they are open inside the nearest of the second set.
CLOSES = {
    "p": (frozenset({"p"}), frozenset("article section div body td th li blockquote main dd figure details".split())),
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
BLOCK_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements too small to be the content region.
PARTS = frozenset("p span a label h1 h2 h3 h4 h5 h6 li td th tr pre blockquote dd dt".split())
#: A form, or an element marked by its class or id, that holds several lines and more than this share of the
#: page's text is a frame around the article, if no article or main element, and no more than
#: the second share of the text, stands outside all such elements.
FRAME_SHARE, OUTSIDE_SHARE = 0.5, 0.25
#: Article and main elements are the content region if they hold more than this share of the high cluster's text.
MOST = 0.5
#: Standard deviation, in lines, of the smoothing.
SIGMA = 1.5

_SPACE = re.compile(r"\s+")


class Lines(HTMLParser):
    """The page as lines: text, number of tags, and the element around it.

    Elements are numbered in the order they open, so inner ones have larger numbers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.parent, self.names, self.marks = [-1], [""], [0]  # marks: 1 never the article's, 2 beside it by class or id
        self.text: list[str] = []
        self.tags = 0
        self.open: Counter[str] = Counter()  # names on the stack
        self.out: list[tuple[str, int, int]] = []

    def cut(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text or self.tags:
            self.out.append((text, self.tags, self.stack[-1][1]))
        self.text, self.tags = [], 0

    def mark(self, tag: str, attrs: list) -> int:
        if tag in NEVER:
            return 1
        inside = self.open["article"] or self.open["main"]
        if tag == "header":
            return int(not inside)
        if tag == "form":
            return 2
        for key, raw in attrs:
            value = (raw or "").lower()
            if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
                return 1
            if key == "style" and re.search(r"display\s*:\s*none", value):
                return 1
            if key not in ("class", "id") or tag in ("html", "body", "main") or tag == "article" and not inside:
                continue
            if not inside:
                if BESIDE.search(value) or HEAD.search(value):
                    return 2
            elif (key == "class" or tag in HOLDERS or tag == "article") and any(map(names_a_part, (raw or "").split())):
                return 2
            elif tag in HOLDERS and NOTICE.search(value) and NOTICE_SHAPE.search(value):
                return 2
        return 0

    def pop_to(self, at: int) -> None:
        self.cut()
        self.open.subtract(x[0] for x in self.stack[at:])
        del self.stack[at:]

    def within(self, own: list[float]) -> list[float]:
        """Sums over each element and all inside it."""
        total = list(own)
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def content(self) -> list[tuple[str, int, int]]:
        """The lines outside marked elements."""
        n = len(self.parent)
        size, lines, never, marked = [0.0] * n, [0.0] * n, [False] * n, [False] * n
        for e in range(n):
            never[e] = self.marks[e] == 1 or e > 0 and never[self.parent[e]]
            marked[e] = self.marks[e] == 2 or e > 0 and marked[self.parent[e]]
        for text, _, e in self.out:
            size[e] += 0 if never[e] else len(text)
            lines[e] += bool(text) and not never[e]
        outside = sum(s for s, m in zip(size, marked) if not m)
        size, lines = self.within(size), self.within(lines)
        clear = any(self.names[e] in ("article", "main") and size[e] and not marked[e] for e in range(n)) or outside > OUTSIDE_SHARE * size[0]
        for e in range(1, n):
            frame = not clear and lines[e] > 1 and size[e] > FRAME_SHARE * size[0]
            never[e] = never[e] or never[self.parent[e]] or self.marks[e] == 2 and not frame
        kept = [x for x in self.out if x[0] and not never[x[2]]]
        return self.without_comments(kept)

    def without_comments(self, lines: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        n = len(self.parent)
        # The nearest article around each element, and articles with a paragraph of their own.
        article, own = [0] * n, [False] * n
        for e in range(1, n):
            article[e] = e if self.names[e] == "article" else article[self.parent[e]]
        for _, _, e in lines:
            own[article[e]] = own[article[e]] or self.names[e] == "p"
        gone = [False] * n
        for e in range(1, n):
            around = article[self.parent[e]]
            gone[e] = gone[self.parent[e]] or self.names[e] == "article" and around > 0 and own[around]
        lines = [x for x in lines if not gone[x[2]]]
        said = [0.0] * n
        for _, _, e in lines:
            said[e] += 1
        said = self.within(said)
        until, out = set(), []  # elements inside which nothing more is kept
        for text, tags, e in lines:
            if self.names[e] in HEADINGS and COMMENTS.fullmatch(text):
                place = self.parent[e]
                while said[place] == 1 and place > 0:
                    place = self.parent[place]
                until.add(place)
            if not until or not self._inside(e, until):
                out.append((text, tags, e))
        return out

    def _inside(self, e: int, marked: set[int]) -> bool:
        while e >= 0 and e not in marked:
            e = self.parent[e]
        return e >= 0

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            self.tags += 1
            if tag in ("br", "img", "wbr"):
                self.text.append(" " if tag == "br" else "")
                return
            if tag not in ("span", "a", "label") or not self.mark(tag, attrs):
                return
            self.cut()  # an inline element beside the article counts as a block
        else:
            self.cut()
            self.tags += 1
        closed, until = CLOSES.get(tag, (None, None))
        if closed is None and tag in BLOCK_CLOSES_P:
            closed, until = frozenset({"p"}), CLOSES["p"][1]
        if closed and any(self.open[x] for x in closed):
            for i in range(len(self.stack) - 1, 0, -1):
                name = self.stack[i][0]
                if name in until:
                    break
                if name in closed:
                    self.pop_to(i)
                    if tag not in ("td", "th", "tr", "li", "dt", "dd"):
                        break
        if tag in VOID:
            return
        self.parent.append(self.stack[-1][1])
        self.names.append(tag)
        self.marks.append(self.mark(tag, attrs))
        self.stack.append((tag, len(self.parent) - 1))
        self.open[tag] += 1

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in INLINE:
            self.tags += 1
            if self.stack[-1][0] != tag:
                return
        for i in range(len(self.stack) - 1, 0, -1) if self.open[tag] else ():
            if self.stack[i][0] == tag:
                self.tags += tag not in INLINE
                self.pop_to(i)
                return
        if tag not in INLINE:
            self.cut()

    def handle_data(self, data):
        self.text.append(data)


def names_a_part(name: str) -> bool:
    """Whether one class or id names a menu, advert, comment list or the like: it has such a
    word, and no other words than where and in what shape it stands."""
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
    return any(w in BESIDE_WORDS for w in words) and all(w in BESIDE_WORDS or w in PLACE_WORDS for w in words)


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, reach), kernel / kernel.sum(), "valid")


def threshold(value: np.ndarray) -> float:
    """Midway between the means of the two clusters that one-dimensional 2-means finds."""
    cut = float(value.mean())
    for _ in range(50):
        high = value > cut
        if not high.any() or high.all():
            break
        new = (value[high].mean() + value[~high].mean()) / 2
        if new == cut:
            break
        cut = new
    return cut


def main_blocks(html: str | None) -> list[str]:
    """Blocks of the page's main text, in page order; none for a null or empty page."""
    page = Lines()
    page.feed(html or "")
    page.close()
    page.cut()
    lines = page.content()
    if not lines:
        return []
    size = np.array([len(x[0]) for x in lines], float)
    ratio = smoothed(np.log1p(size / np.maximum(1, [x[1] for x in lines])))
    high = ratio >= threshold(ratio)
    own = [0.0] * len(page.parent)
    for n, of_article, (_, _, e) in zip(size, high, lines):
        own[e] += n if of_article else 0.0
    around = page.within(own)
    holds = lambda e: page.names[e] in ("article", "main")
    outer, inside = [0] * len(own), [False] * len(own)  # the outermost article or main element around each
    for e in range(1, len(own)):
        outer[e] = outer[page.parent[e]] or (e if holds(e) else 0)
    if sum(n for n, of_article, (_, _, e) in zip(size, high, lines) if of_article and outer[e]) > MOST * around[0]:
        inside = [o > 0 for o in outer]
    else:
        region = max((e for e in range(len(own)) if around[e] >= around[0] and page.names[e] not in PARTS), default=0)
        for e in range(len(own)):
            inside[e] = e == region or e > 0 and inside[page.parent[e]]
    kept = [k for k, (_, _, e) in enumerate(lines) if inside[e]]
    titles = [k for k in range(kept[0] if kept else 0) if page.names[lines[k][2]] == "h1"]
    if titles and not any(page.names[lines[k][2]] == "h1" for k in kept):
        kept = [titles[-1], *kept]
    return [lines[k][0] for k in kept]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of each page row; ``text`` joins the main blocks by a line feed.

    Null and empty pages, and pages without text, give the empty text. Broken markup is
    read as the parser reads it. Rows stay apart, also if ids repeat; other columns are
    not read."""
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                text = ["\n".join(main_blocks(x)) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(text, pa.string())], ["id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string").withColumnsRenamed({"id": id_col, "url": url_col})
