"""Main text of web pages by tag-path ratios: text and punctuation per root-to-leaf path tell content from the rest."""

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How HTML elements behave, and what never belongs to an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                           "main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
NEVER = frozenset("head script style noscript template iframe object svg math canvas nav aside footer form button select textarea "
                  "dialog menu title audio video map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner banners sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs topbar toolbar pagination pager masthead header footer sidebar sidebars aside "
    "widget widgets cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay disclaimer copyright "
    "comment comments commentlist commentary reply replies respond discussion disqus feedback share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login search paywall skip tags".split())
# Of these, names that within an article can be of its text, such as a box of notes or a section on related work. They are of the
# text if there is a heading inside, and most of what is inside is on content paths.
PROSE = frozenset("notice notices notification alert alerts disclaimer copyright commentary feedback related recommended "
                  "recommendations search header respond skip login signup subscription discussion".split())
# Names of readers' comments and of what is at the side: as a class, or as an id or part of one, they bar an element. An id is let
# pass if the heading inside says the same, as it is made from that heading then.
READERS = frozenset("comment comments commentlist reply replies respond disqus sidebar".split())
SLUGGED = HEADINGS | frozenset("section p blockquote pre li td th dt dd figure table".split())  # their ids are made from headings
WIDE = frozenset("#root html body".split())
TEXTUAL = frozenset("html body article main".split())  # their names say nothing about what is in them
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
BESIDE = re.compile(r"(?:has|with|no|without|is)[-_]")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:([\"'])|([^\s>]*)))?")
_GAP = re.compile(r"[\s/]*")
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")}


def markup(page: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """("start", tag, attributes), ("end", tag, None) and ("text", characters, None) of a page, in one pass.

    What is begun and never ended (a comment, a tag, a quoted value, a script) ends with the page, so no part is looked through
    twice, whatever is missing.
    """
    at, size = 0, len(page)
    while at < size:
        opened = page.find("<", at)
        if opened < 0:
            opened = size
        if opened > at:
            yield "text", unescape(page[at:opened]), None
        at = opened
        if at >= size:
            return
        if page.startswith("<!--", at):
            if page.startswith(("<!-->", "<!--->"), at):
                at = page.index(">", at) + 1
                continue
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
            continue
        closing = page.startswith("/", at + 1)
        name = _NAME.match(page, at + 1 + closing)
        if not name:
            if page[at + 1: at + 2] in ("!", "?", "/"):  # a declaration, or nothing that is known
                end = page.find(">", at)
                at = end + 1 if end >= 0 else size
            else:
                yield "text", "<", None
                at += 1
            continue
        tag, at, attributes = name[0].lower(), name.end(), {}
        while True:
            at = _GAP.match(page, at).end()
            if at >= size:
                return
            if page[at] == ">":
                at += 1
                break
            found = _ATTRIBUTE.match(page, at)
            at, value = found.end(), found[3] or ""
            if found[2]:
                end = page.find(found[2], at)
                if end < 0:
                    return
                value, at = page[at:end], end + 1
            attributes.setdefault(found[1].lower(), unescape(value))
        if closing:
            yield "end", tag, None
            continue
        yield "start", tag, attributes
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.start() if end else size


class Page:
    """A page's elements and texts as flat lists: an element knows its parent, path and place; a text its element and block."""

    def __init__(self, html: str):
        self.parent, self.path, self.tag, self.barred, self.link, self.heading = [-1], [0], ["#root"], [False], [False], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.within = [False]  # an article or the main part
        self.part = [False]  # the element itself is one
        self.slug: dict[int, str] = {}  # the ids that bar their elements unless a heading inside says the same
        self.holder = [0]  # the innermost element around that is not inline, or itself
        self.doubtful: list[int] = []  # elements with names that may be of the text
        self.open = [0]
        self.opened: dict[str, int] = defaultdict(int)
        self.block = 0
        self.texts: list[tuple[int, int, str]] = []
        for kind, what, attributes in markup(html):
            if kind == "text":
                self.texts.append((self.open[-1], self.block, what))
            elif kind == "start":
                self._start(what, attributes)
            else:
                self._end(what)
        self._settle()

    def _settle(self) -> None:
        """Lets pass the ids made from headings, and hands down what is barred."""
        if self.slug:
            said: dict[int, list[str]] = defaultdict(list)
            for e, _, text in self.texts:
                if self.tag[self.holder[e]] in HEADINGS:
                    said[self.holder[e]].append(text)
            for e in sorted(said):
                slug, up = _slug("".join(said[e])), self.parent[e]
                for _ in range(4):  # a heading stands right inside, or in a box or two
                    if self.slug.get(up) == slug:
                        del self.slug[up]
                    up = self.parent[up] if up > 0 else 0
            for e in self.slug:
                self.barred[e] = True
        for e in range(1, len(self.parent)):  # parents come before their children
            self.barred[e] |= self.barred[self.parent[e]]

    def _names(self, named: str) -> set[str]:
        """The words in class or id; a name such as has-sidebar is of what is beside, not of what is in the element."""
        return {part.lower() for name in named.split() if not BESIDE.match(name) for part in NAME_PARTS.findall(name)}

    def _beside(self, number: int, tag: str, attributes: dict[str, str], within: bool) -> bool:
        """Whether class or id say that the element is not of the text. Ids of headings, sections and the like are made from
        headings, and say nothing unless they name comments or what is at the side. Within an article no heading is barred,
        and names that can be of prose only make an element doubtful."""
        classes, own = self._names(attributes.get("class", "")), attributes.get("id", "")
        named = self._names(own)
        if within and tag in HEADINGS:
            return False
        if tag not in SLUGGED - {"section"} and named & READERS:
            self.slug[number] = _slug(own)
        if not within:
            return bool(classes & NAMES) or tag not in SLUGGED and bool(named & (NAMES - READERS))
        if classes & PROSE and not classes & {"comment", "comments"} or tag not in SLUGGED and own.lower() in PROSE:
            self.doubtful.append(number)
        return bool(classes & (NAMES - PROSE)) or tag not in SLUGGED and own.lower() in NAMES - PROSE - READERS

    def _barred(self, number: int, tag: str, attributes: dict[str, str], heads: bool, within: bool) -> bool:
        if tag in NEVER or "hidden" in attributes or attributes.get("aria-hidden") == "true":
            return True
        if tag in TEXTUAL:
            return False
        if attributes.get("role", "").lower() in ROLES - ({"alert"} if within else set()) or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
            return True
        return not heads and (tag == "header" or self._beside(number, tag, attributes, within))

    def _start(self, tag, attributes):
        if tag not in INLINE:
            self.block += 1
        if tag in VOID:
            if tag == "br":
                self.texts.append((self.open[-1], self.block, " "))
            return
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"td", "th", "table", "button", "object"})
        elif tag in SIBLINGS:
            self._close(*SIBLINGS[tag])
        up = self.open[-1]
        first = attributes.get("class", "").split()
        label = tag + "." + re.sub(r"\d+", "", first[0]) if first and tag not in TEXTUAL else tag
        self.path.append(self.paths.setdefault((self.path[up], label), len(self.paths) + 1))
        self.parent.append(up)
        self.tag.append(tag)
        self.holder.append(self.holder[up] if tag in INLINE else len(self.tag) - 1)
        # a header is the page's; one within an article holds its heading, of which that much is kept
        within = self.within[up]
        heads = within and (tag == "header" or "header" in self._names(f"{attributes.get('class', '')} {attributes.get('id', '')}"))
        beside = self.heading[up] and tag not in HEADINGS and tag not in INLINE and tag != "div"
        self.heading.append(heads or self.heading[up] and tag == "div")
        self.barred.append(beside or self._barred(len(self.parent) - 1, tag, attributes, heads, within))
        self.link.append(self.link[up] or tag == "a")
        self.part.append(tag in ("article", "main") or attributes.get("role", "").lower() in ("article", "main"))
        self.within.append(within or self.part[-1])
        self.open.append(len(self.parent) - 1)
        self.opened[tag] += 1

    def _close(self, tags: set[str], until: set[str] | None):
        """Ends the innermost open element of `tags` and what is in it, unless one of `until` (None: of those that
        are not inline) is in between."""
        if not any(self.opened[t] for t in tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[k]]
            if name in tags:
                for e in self.open[k:]:
                    self.opened[self.tag[e]] -= 1
                del self.open[k:]
                return
            if name not in INLINE if until is None else name in until:
                return

    def _end(self, tag):
        if tag not in INLINE:
            self.block += 1
        if tag in INLINE:  # an inline end ends nothing but inline elements
            self._close({tag}, None)
        elif tag not in VOID:
            self._close({tag}, set())


def _slug(text: str) -> str:
    return "-".join(re.findall(r"\w+", text.lower()))


def smoothed(values: np.ndarray) -> np.ndarray:
    """Each value with its neighbours', by a normal kernel over two on either side."""
    kernel = np.exp(-np.arange(-2, 3) ** 2 / 2)
    return np.convolve(values, kernel, "same") / np.convolve(np.ones(len(values)), kernel, "same") if len(values) > 4 else values


def content_elements(page: Page, nodes: list[tuple[int, str]], strictness: float) -> np.ndarray:
    """Which text nodes (element, text) lie on content paths.

    A path's ratios are its mean text length and mean punctuation per node; in page order they are smoothed and multiplied.
    A path is content if its mean fused ratio reaches `strictness` standard deviations of all nodes', and links are not
    most of its text.
    """
    path = np.array([page.path[e] for e, _ in nodes])
    known, which = np.unique(path, return_inverse=True)
    size = np.array([len(t) for _, t in nodes], float)
    marks = np.array([len(PUNCTUATION.findall(t)) for _, t in nodes], float)
    linked = np.array([page.link[e] for e, _ in nodes])
    count = np.bincount(which)
    per_path = lambda v: np.bincount(which, v, len(known)) / count
    fused = smoothed(per_path(size)[which]) * (1 + smoothed(per_path(marks)[which]))
    share_linked = np.bincount(which, size * linked, len(known)) / np.bincount(which, size, len(known))
    content = (per_path(fused) >= strictness * fused.std()) & (share_linked < 0.5)
    return content[which]


def beside_content(page: Page, nodes: list[tuple[int, str]], content: np.ndarray) -> np.ndarray:
    """Which elements within an article go by what their paths say.

    An element of a doubtful name stays if there is a heading inside and at least half of its other text is on content paths and in no
    link. Of several articles beside each other those that hold under a tenth of the largest one's content are teasers.
    """
    count = len(page.parent)
    total, kept, heads = np.zeros(count), np.zeros(count), np.zeros(count, bool)
    for (e, text), c in zip(nodes, content):
        if page.tag[page.holder[e]] in HEADINGS:
            heads[e] = True
        else:
            total[e] += len(text)
            kept[e] += len(text) * (c and not page.link[e])
    for e in range(count - 1, 0, -1):
        up = page.parent[e]
        total[up] += total[e]
        kept[up] += kept[e]
        heads[up] |= heads[e]
    gone = np.zeros(count, bool)
    for e in page.doubtful:
        gone[e] = not heads[e] or kept[e] * 2 < total[e]
    articles: dict[int, list[int]] = defaultdict(list)
    for e in range(1, count):
        if page.tag[e] == "article" and not page.barred[e]:
            articles[page.parent[e]].append(e)
    for beside in articles.values():
        most = max(kept[e] for e in beside)
        for e in beside:
            gone[e] |= kept[e] * 10 < most
    for e in range(1, count):
        gone[e] |= gone[page.parent[e]]
    return gone


def main_text(html: str, strictness: float = 0.8, share: float = 0.8) -> str:
    """The article of a page: see `extract`."""
    page = Page(html)
    shown = [(e, b, t) for e, b, t in page.texts if not page.barred[e]]
    nodes = [(e, t.strip()) for e, _, t in shown if t.strip()]
    if not nodes:
        return ""
    content = content_elements(page, nodes, strictness)
    gone = beside_content(page, nodes, content)
    if gone.any():
        shown = [x for x in shown if not gone[x[0]]]
        left = [not gone[e] for e, _ in nodes]
        nodes, content = [x for x, n in zip(nodes, left) if n], content[left]
        if not nodes:
            return ""
    if not content.any():
        content[:] = True
    weight, number = np.zeros(len(page.parent)), np.zeros(len(page.parent), int)
    for (e, t), c in zip(nodes, content):
        weight[e] += len(t) * c
        number[e] += c
    for e in range(len(weight) - 1, 0, -1):  # parents come before their children
        weight[page.parent[e]] += weight[e]
        number[page.parent[e]] += number[e]
    blocks_only = [e == 0 or page.tag[e] not in INLINE and page.tag[e] != "p" for e in range(len(weight))]
    home = max(e for e in range(len(weight)) if number[e] == number[0] and blocks_only[e])
    core = max(e for e in range(len(weight)) if weight[e] >= share * weight[0] and blocks_only[e] or e == 0)
    if page.tag[home] in WIDE:  # some is far from the rest: all of what holds most of it, and of the others the content
        home = core
    if page.within[home]:
        while not page.part[home]:
            home = page.parent[home]
    inside, most, block = np.zeros(len(weight), bool), np.zeros(len(weight), bool), [0] * len(weight)
    inside[home], most[core] = True, page.tag[core] not in WIDE
    for e in range(1, len(weight)):
        inside[e] |= inside[page.parent[e]]
        most[e] |= most[page.parent[e]]
        block[e] = block[page.parent[e]] if page.tag[e] in INLINE else e

    chosen = {b for (_, b, _), c in zip((x for x in shown if x[2].strip()), content) if c}
    beside = {page.parent[block[e]] for (e, _), c in zip(nodes, content) if c}
    chosen |= {b for e, b, _ in shown if page.tag[block[e]] in HEADINGS and page.parent[block[e]] in beside}
    linked, total, blocks = defaultdict(int), defaultdict(int), defaultdict(list)
    for e, b, t in shown:
        if inside[e] or b in chosen:
            blocks[b].append(t)
            total[b] += len(t.strip())
            linked[b] += len(t.strip()) * page.link[e]
    # in an article or amid most of the text a list of links is of the text; elsewhere it can be a menu
    lists = {b for e, b, t in shown
             if not page.within[e] and not most[e] and b not in chosen and page.tag[e] in ("a", "li") and total[b] and linked[b] == total[b]}
    lines = (" ".join("".join(parts).split()) for b, parts in blocks.items() if b not in lists)
    return " ".join(line for line in lines if line)


def extract(pages: DataFrame, strictness: float = 0.8, share: float = 0.8) -> DataFrame:
    """Main text of every page in `pages` (`page_id`, `url`, `html`).

    Text nodes outside what never is article (scripts, menus, forms and the like, by element, role or name) are grouped by
    their root-to-leaf tag path. Content paths are those with much text and punctuation per node, smoothed along the page.
    The innermost element around all of them, or the article or main part that it is in, is the article: all of it is kept,
    short paragraphs, headings and lists of links too. Where that is the whole body, it is the innermost with `share` of their
    text, and outside it what is on content paths, with the headings beside, is kept as well. Blocks that are nothing but
    links go outside articles and outside of what holds that share. Within an article the paths decide on what bears a doubtful name
    (a notice, a box on related work) and on further articles (`beside_content`); readers' comments go by their names.

    Per row: page_id, url, text (blocks in page order, one space between; empty if none), n_chars (code points). A NULL html is
    an empty one; NULL ids and urls are kept; repeated rows come out once each; an empty table gives no rows; other columns are
    ignored. A page is one row's work, however long, and grows with its length alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "", strictness, share) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col("page_id").cast("long"), "url", "html")
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
