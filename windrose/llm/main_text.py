"""Main text of web pages by scoring the tree.

A page is parsed into a tree of elements and blocks of text. Elements that by their tag, role or style, or
by a class or id that names nothing else, are no part of an article (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments) are left out. A class or id that may also name a
subject (`share-price`, `related-work`, a section called `discussion`) only halves an element's points; it
is left out if mostly links, or if such a word is its whole id and it is short and no heading. Each remaining block gives points for its length and its commas, less the
share of it that is link text, to the element around it and, halved at each step, to that one's ancestors.
The element with most points is the container; if it lies in an article (or main) element, that one is
taken whole. Siblings of the container are kept if their points come near, or if they are headings or
paragraphs that are no lists of links. The kept blocks are joined in page order.

White space inside a block becomes one space; blocks are joined by one space; character references are
decoded. Everything works in one pass over a page's own tree, without recursion.

Defined results: a null or empty html, or a page without text, gives the empty text; a page that is cut off
or badly nested is read as far as it goes; plain text without any tag is its own container; repeated rows
are judged alike; other columns pass unread.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm.common import prepare, table

# Element names of the HTML standard, and words that name page furniture.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
_FURNITURE = frozenset(
    "head script style noscript template nav footer aside form button select textarea option fieldset "
    "iframe object embed svg canvas audio video dialog menu map title input".split()
)
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar "
    "tablist status tooltip".split()
)
#: Words that name furniture whatever describes them ("reader-comments").
_STRONG_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense sponsored promo cookie cookies gdpr "
    "popup modal lightbox newsletter subscribe signup login "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside "
    "footer masthead topbar toolbar pagination pager "
    "comment comments commentlist disqus".split()
)
#: Words that name furniture alone or beside others of these lists; else they may describe a subject.
_WEAK_WORDS = frozenset(
    "advertising banner sponsor promotion promotions consent notice notices notification notifications "
    "alert overlay subscription rail foot reply replies respond responses discussion "
    "share sharing social related recommended recommendations widget widgets "
    "disclaimer copyright skip hidden".split()
)
#: Words that say nothing of what a piece of furniture holds: after its name, and anywhere.
_PART_WORDS = frozenset(
    "list item items box boxes container wrapper wrap block blocks section area zone bar bars button buttons "
    "link links icon icons unit slot row col column panel group card cards body content text title heading "
    "thread form open closed active".split()
)
_PLACE_WORDS = frozenset(
    "top bottom left right inner outer main site page post posts article articles entry story stories news "
    "user reader global primary secondary sticky fixed floating this div id js wp".split()
)
#: "no-sidebar" or "with-menu" name something else than furniture.
_QUALIFIERS = frozenset("no non has with without".split())
_HEADER_OF_ARTICLE = frozenset("article entry post story content title section".split())
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTE = re.compile(r"=\s*([\"'])")
_TELLING = re.compile(r"class|id|role|style|hidden", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""")
#: Numeric references far beyond the last character.
_LONG_REFERENCE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9a-fA-F]{9,});?")
#: Elements whose content is no markup.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Tags that an opening tag of the given kind closes, and the tags at which the search for them stops.
_CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
}
_OPEN_PARAGRAPH = frozenset({"p"})
_PARAGRAPH_BOUNDS = frozenset("table td th button article section div li".split())
#: Left out, but within a run of text.
_INSIDE_TEXT = frozenset(
    "script style noscript template svg canvas iframe object embed audio video button select option map".split()
)
_PARAGRAPHS = frozenset("p pre blockquote li td th dd dt figcaption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WHOLE = ("article", "main")

_SIBLING_SHARE = 0.2
#: How surely a class or id names furniture.
_SURE, _WHOLE_ID, _IN_DOUBT, _NONE = 3, 2, 1, 0
_DOUBT_SHARE = 0.5
_SHORT = 120
_POINTS_PER_BLOCK = 1.0
_CHARS_PER_POINT = 100
_MOST_LENGTH_POINTS = 3.0


def _is_furniture(tag: str, attributes: dict[str, str]) -> bool:
    """By tag, role, style or attributes, which leave no doubt."""
    return (
        tag in _FURNITURE
        or "hidden" in attributes
        or attributes.get("aria-hidden") == "true"
        or attributes.get("role", "").lower() in _FURNITURE_ROLES
        or bool(_HIDDEN.search(attributes.get("style", "")))
    )


def _name(words: list[str], is_id: bool) -> int:
    """The verdict on one class or id."""
    words = [w for before, w in zip(["", *words], words, strict=False) if before not in _QUALIFIERS]
    names = [w in _STRONG_WORDS or w in _WEAK_WORDS for w in words]
    if not any(names):
        return _NONE
    first = names.index(True)
    core = [w for i, w in enumerate(words) if w not in _PLACE_WORDS and (i < first or w not in _PART_WORDS)]
    found = [w in _STRONG_WORDS or w in _WEAK_WORDS for w in core]
    if core[-1] in _STRONG_WORDS or all(found) and (len(words) > 1 or not is_id):
        return _SURE
    return _WHOLE_ID if all(found) else _IN_DOUBT


def _named(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """By class or id, which may also be said of a subject, or of what surrounds an article."""
    if tag in ("html", "body"):
        return _NONE
    classes = [_WORD.findall(c) for c in attributes.get("class", "").lower().split()]
    # Ids of headings are made of their texts.
    ids = [] if tag in _HEADINGS else [_WORD.findall(c) for c in attributes.get("id", "").lower().split()]
    if not in_article:
        called = tag == "header" or any({"header"} | _PLACE_WORDS | _PART_WORDS >= set(w) for w in [*classes, *ids] if "header" in w)
        if called and _HEADER_OF_ARTICLE.isdisjoint(w for words in [*classes, *ids] for w in words):
            return _SURE
    return max([_NONE, *(_name(w, False) for w in classes), *(_name(w, True) for w in ids)])


class _Element:
    """`furniture`: surely none of the article; `named`, `doubt`: called so; `left_out`: the verdict."""

    __slots__ = (
        "blocks", "children", "doubt", "furniture", "interrupted", "left_out", "named", "parent", "points", "tag",
    )

    def __init__(self, tag: str, parent: "_Element | None", furniture: bool, named: int) -> None:
        self.tag, self.parent, self.furniture = tag, parent, furniture
        self.named, self.doubt = named == _SURE, named if named < _SURE else _NONE
        self.left_out = False
        self.interrupted: _Block | None = None
        self.children: list[_Element] = []
        self.blocks: list[_Block] = []
        self.points = 0.0


def _is_block(element: _Element) -> bool:
    return element.tag not in _INLINE or element.furniture or element.named


class _Block:
    """A run of text and inline elements directly inside a block element."""

    __slots__ = ("linked", "parts", "text")

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.linked = 0
        self.text = ""


def _tag_end(html: str, start: int, last: dict[str, int]) -> int:
    """The place of the `>` that ends a tag, looking past quoted values; -1 if there is none."""
    end, at = html.find(">", start), start
    while end >= 0:
        value = _QUOTE.search(html, at, end)
        if value is None or value.end() > last[value[1]]:
            return end
        at = html.index(value[1], value.end()) + 1
        if at > end:
            end = html.find(">", at)
    return -1


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of texts, start and end tags; each character is seen once.

    Comments, declarations and the contents of scripts and the like are skipped, and so is a tag that
    is cut off.
    """
    last = {quote: html.rfind(quote) for quote in "\"'"}
    at = 0
    while True:
        start = html.find("<", at)
        if start < 0:
            yield "text", html[at:], ""
            return
        if start > at:
            yield "text", html[at:start], ""
        name = _NAME.match(html, start + 1)
        if name is not None:
            tag = name[2].lower()
            end = _tag_end(html, name.end(), last)
            if end < 0:
                return
            at = end + 1
            if name[1]:
                yield "end", tag, ""
                continue
            yield "start", tag, html[name.end() : end]
            if tag in _RAW:
                closing = re.compile(f"</{tag}", re.I).search(html, at)
                if closing is None:
                    return
                at = closing.start()
        elif html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            if end < 0:
                return
            at = end + 3
        elif html[start + 1 : start + 2] in ("!", "?", "/"):
            end = html.find(">", start)
            if end < 0:
                return
            at = end + 1
        else:
            yield "text", "<", ""
            at = start + 1


def _decoded(text: str) -> str:
    if "&" not in text:
        return text
    return unescape(_LONG_REFERENCE.sub("\ufffd", text))


class _Tree:
    """The elements of a page, and its blocks in page order."""

    def __init__(self, html: str) -> None:
        self.root = _Element("", None, False, _NONE)
        self.elements = [self.root]
        self.order: list[tuple[_Element, _Block]] = []
        self.open = [self.root]
        self.count: Counter[str] = Counter()
        self.block: _Block | None = None
        for kind, name, attributes in _tokens(html):
            if kind == "text":
                self._add(_decoded(name))
            elif kind == "start":
                self._start(name, attributes)
            else:
                self._end(name)

    def _start(self, tag: str, raw: str) -> None:
        if tag == "br":
            self._add(" ")
            return
        if tag in _VOID:
            if tag == "hr":
                self.block = None
            return
        in_article = self.count["article"] + self.count["main"] > 0
        if raw and _TELLING.search(raw):
            attributes = {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTE.findall(raw)}
            furniture = _is_furniture(tag, attributes)
            named = _named(tag, attributes, in_article)
        else:
            furniture, named = tag in _FURNITURE, _SURE if tag == "header" and not in_article else _NONE
        if tag not in _INLINE and tag not in _INSIDE_TEXT:
            if tag in _CLOSES:
                self._close(*_CLOSES[tag])
            else:
                self._close(_OPEN_PARAGRAPH, _PARAGRAPH_BOUNDS)
        element = _Element(tag, self._element(), furniture, named)
        # Text goes on after what is left out within it.
        element.interrupted = self.block if tag in _INLINE or tag in _INSIDE_TEXT else None
        if _is_block(element):
            self.block = None
            element.parent.children.append(element)
            self.elements.append(element)
        self.open.append(element)
        self.count[tag] += 1

    def _element(self) -> _Element:
        """The innermost open block element."""
        last = self.open[-1]
        return last if last is self.root or _is_block(last) else last.parent

    def _close(self, tags: frozenset[str], until: frozenset[str]) -> None:
        """Closes the innermost open elements of these tags, not looking beyond `until`."""
        while any(self.count[t] for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in tags:
                    self._pop(i)
                    break
                if self.open[i].tag in until:
                    return

    def _pop(self, place: int) -> None:
        for element in reversed(self.open[place:]):
            self.count[element.tag] -= 1
            if _is_block(element):
                self.block = element.interrupted
        del self.open[place:]

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._add(" ")
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._pop(i)
                return
            # An inline end tag does not close the block around it.
            if tag in _INLINE and _is_block(self.open[i]):
                return

    def _add(self, data: str) -> None:
        if self.block is None:
            if not data or data.isspace():
                return
            element = self._element()
            self.block = _Block()
            element.blocks.append(self.block)
            self.order.append((element, self.block))
        self.block.parts.append(data)
        if self.count["a"] > 0:
            self.block.linked += len(data.strip())


def _judge(elements: list[_Element]) -> None:
    """Leaves out furniture with all it holds, but no mere name that surrounds an article."""
    holds_article = set()
    for element in reversed(elements):
        if id(element) in holds_article or element.tag in _WHOLE and not (element.named or element.furniture):
            holds_article.add(id(element.parent))
    chars: Counter[int] = Counter()
    linked: Counter[int] = Counter()
    if any(e.doubt for e in elements):
        for element in reversed(elements):
            chars[id(element)] += sum(len(b.text) for b in element.blocks)
            linked[id(element)] += sum(b.linked for b in element.blocks)
            chars[id(element.parent)] += chars[id(element)]
            linked[id(element.parent)] += linked[id(element)]
    for element in elements:
        inherited = element.parent is not None and element.parent.left_out
        named = element.named
        if element.doubt and element.tag not in _HEADINGS:
            length = chars[id(element)]
            named |= 2 * linked[id(element)] > length or element.doubt == _WHOLE_ID and length < _SHORT
        element.left_out = inherited or element.furniture or named and id(element) not in holds_article


def _score(elements: list[_Element]) -> None:
    """Points of blocks go to the element around them, halves on to its ancestors."""
    for element in reversed(elements):  # children come after their parents
        if element.left_out:
            continue
        own = 0.0
        for block in element.blocks:
            if element.tag in _HEADINGS or not block.text:
                continue
            points = _POINTS_PER_BLOCK + block.text.count(",")
            points += min(len(block.text) / _CHARS_PER_POINT, _MOST_LENGTH_POINTS)
            own += points * (1 - min(1.0, block.linked / len(block.text)))
        if element.doubt:
            own, element.points = own * _DOUBT_SHARE, element.points * _DOUBT_SHARE
        parent = element.parent
        if parent is None:
            element.points += own
        elif element.tag in _PARAGRAPHS or element.tag in _INLINE:
            parent.points += own + element.points / 2
        else:
            element.points += own
            parent.points += element.points / 2


def _is_prose(element: _Element) -> bool:
    text = sum(len(b.text) for b in element.blocks)
    linked = sum(b.linked for b in element.blocks)
    return text > 0 and 2 * linked < text


def _kept(elements: list[_Element]) -> list[_Element]:
    """The container and those of its siblings that belong to it."""
    candidates = [e for e in elements if not e.left_out and e.tag not in _PARAGRAPHS]
    best = max(candidates, key=lambda e: e.points, default=None)
    if best is None or best.points <= 0:
        return [elements[0]]
    for tag in _WHOLE:
        around: _Element | None = best
        while around is not None and around.tag != tag:
            around = around.parent
        if around is not None:
            return [around]
    if best.parent is None:
        return [best]
    least = max(10.0, _SIBLING_SHARE * best.points)
    return [
        e
        for e in best.parent.children
        if e is best
        or not e.left_out
        and (e.points >= least or e.tag in (*_PARAGRAPHS, *_HEADINGS) and _is_prose(e))
    ]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    tree = _Tree(html)
    for _, block in tree.order:
        block.text = " ".join("".join(block.parts).split())
    _judge(tree.elements)
    _score(tree.elements)
    kept = set(map(id, _kept(tree.elements)))
    # Parents come before their children, so one pass marks whole subtrees.
    for element in tree.elements:
        if element.left_out:
            kept.discard(id(element))
        elif element.parent is not None and id(element.parent) in kept:
            kept.add(id(element))
    return " ".join(b.text for e, b in tree.order if id(e) in kept and b.text)


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for page in pages:
            yield pd.Series([main_text(h) for h in page], dtype=object)

    return extract(html)


def with_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages with page_id, url and html."""
    prepare(pages.sparkSession)
    texts = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return with_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))


QUERIES = {"op7_main_text": op7_main_text}
ORACLE_SQL: dict[str, str] = {}
