"""Main text of web pages: blocks are labelled by a minimum cut."""

from __future__ import annotations

import re
from collections.abc import Set
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from entitylake.llm.batches import column, share_code
from entitylake.llm.mincut import minimum_cut

TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)|[!?/][^>]*+>)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CUT_OFF = re.compile(r"<[a-zA-Z/!?][^>]*\Z")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Raw text: no tag counts before the end tag ...
RAW = frozenset("script style textarea title iframe noframes xmp".split())
# ... and elements with tags in them whose text is not shown as such.
DROPPED = frozenset("template noscript object svg math canvas audio video select button".split())
# No article is in one of these, and none is in itself.
SHORT = frozenset("canvas audio video select button".split())
DROPPED_ENDS = re.compile(rf"</({'|'.join(sorted(DROPPED))})(?=[\s/>])", re.I)
# An open element of the key ends where one of the values begins.
ENDS = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog search fieldset head".split())
# Words in class, id and role ...
BOILERPLATE_NAMES = frozenset(
    "ad ads adv adsense nav side aside rail menu share social related reply replies respond responses reactions alert gdpr "
    "login signup subscribe modal overlay pager toolbar topbar masthead logo tagline trending popular teaser search "
    "complementary contentinfo dialog discussion feedback privacy paywall announcement".split()
)
# ... and parts of words.
BOILERPLATE_PARTS = re.compile(
    "advert|adsby|adbox|adslot|adunit|sponsor|promo|banner|cookie|consent|notice|notification|sidebar|navbar|navigation|"
    "subnav|topnav|breadcrumb|footer|comment(?!ar|at)|disqus|sharing|recommend|newsletter|subscription|popup|widget|paginat|copyright|"
    "disclaimer"
)
# Of these, the names of what readers write ...
READERS_NAMES = frozenset("reply replies respond responses reactions discussion feedback".split())
READERS_PARTS = re.compile("comment(?!ar|at)|disqus")
# ... and of what a page's layout may be called too: with one of LAYOUT beside them, around the page's text.
LAYOUT_PARTS = re.compile("sidebar|widget|banner")
LAYOUT = frozenset("wrap wrapper container content layout inner outer element elementor page site main".split())
# What follows one of these in a class says what a page has.
HAVING = frozenset("has no with without".split())
ARTICLE_NAMES = frozenset("article post story hentry".split())
CONTENT_NAMES = frozenset("article content post entry story body text main prose".split())
# What an element that is called boilerplate takes from the blocks in it, up to FULL of the page's text
# without links; from there on less, and nothing at FREE, as a page is seldom mostly boilerplate.
PENALTY, FULL, FREE = 16.0, 1 / 3, 1 / 2
# Of the text in the main element, the share in links that makes it a list of links.
LISTING = 0.7
# Headings of lists that lead away from an article.
ELSEWHERE = re.compile(
    r"(?:(?:more|other|latest|popular|top|recent|related|recommended|similar|trending) "
    r"(?:stories|articles|posts|news|reading|content|links|pages|topics|from .*|on .*|in .*|for you)|related|read more|read next|up next|"
    r"see also|more like this|most (?:read|popular|viewed)|you (?:may|might) (?:also )?(?:like|enjoy)|recommended(?: for you)?|trending(?: now)?)\W*",
    re.I,
)


@dataclass
class Block:
    """A run of text without a block boundary in it."""

    text: str
    tag: str
    path: tuple[int, ...]
    linked: float
    holder: _Open | None
    inside: float = 0.0  # what the elements around it say: content above 0, boilerplate below
    in_article: bool = False
    in_listing: bool = False


@dataclass
class _Open:
    tag: str
    number: int
    article: bool  # whether an article or main element is around it
    outer: _Open | None = None
    names: frozenset[str] = frozenset()
    own: bool = False  # whether it is in an article element, or is one
    text: int = 0  # characters in it, without links; of the whole page in _Page.weigh
    every: int = 0  # characters in it
    listing: bool = False  # whether it is in a main element that is a list of links
    holds: bool = False  # whether it is or holds the main element or an article with much of the text
    good: float = 0.0  # what the element and those around it say for content ...
    form: float = 0.0  # ... and against it
    bad: float = 0.0
    hidden: bool = False
    dropped: bool = False
    ended: bool = True  # whether an end tag of its name follows


HIDDEN = "(hidden)"


def names_in(attributes: str) -> set[str]:
    """The words in a tag's class, id and role, and ``HIDDEN`` if the element does not show."""
    names: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        value = values[0] or values[1] or values[2]
        name = name.lower()
        if name in ("class", "id", "role", "itemprop"):
            for one in value.split():
                words = list(map(str.lower, TOKEN.findall(one)))
                names.update(words[: next((i for i, word in enumerate(words) if word in HAVING), len(words))])
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            names.add(HIDDEN)
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            names.add(HIDDEN)
    return names


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    opened: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    count: int = 0
    whole: int = 0  # characters of the page, without links
    dropped: list[int] = field(default_factory=list)  # places of dropped elements in the stack

    def shown(self) -> list[_Open]:
        return self.stack[: self.dropped[0]] if self.dropped else self.stack

    def flush(self, stack: list[_Open] | None = None) -> None:
        if self.parts:
            stack = self.shown() if stack is None else stack
            text = "".join(self.parts)
            self.parts.clear()
            total, linked, self.linked = len(text), self.linked, 0
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                holder = next((o for o in reversed(stack) if o.tag in BLOCKS), None)
                path = tuple(o.number for o in stack if o.tag in BLOCKS)
                inner, alone = stack[-1] if stack else None, round(len(text) * (1 - linked / total))
                self.whole += alone
                if inner:
                    inner.text += alone
                    inner.every += len(text)
                self.blocks.append(Block(text, holder.tag if holder else "", path, linked / total, inner))

    def add(self, text: str) -> None:
        if self.dropped:
            return
        self.parts.append(text)
        if self.links:
            self.linked += len(text)

    def drop(self, tag: str, ended: bool) -> None:
        """An element whose text is not added; it ends with its parent at the latest."""
        if tag in SHORT:
            self.close(tag)
        self.count += 1
        outer = self.stack[-1] if self.stack else None
        self.dropped.append(len(self.stack))
        article, own = (outer.article, outer.own) if outer else (False, False)
        self.stack.append(_Open(tag, self.count, article, outer, own=own, dropped=True, ended=ended))

    def open(self, tag: str, attributes: str) -> None:
        if self.dropped and tag in BLOCKS and tag != "option":  # a dropped element without an end does not take in what follows
            for place in self.dropped:
                held = self.stack[place]
                if not held.ended or held.tag in SHORT and tag in ("article", "main"):
                    while len(self.stack) > place:
                        self.pop()
                    break
        while self.stack and self.stack[-1].tag in ENDS and tag in ENDS[self.stack[-1].tag]:
            self.pop()
        if tag in BLOCKS:  # an unclosed inline element does not keep a paragraph open
            for place in range(len(self.stack) - 1, -1, -1):
                own = self.stack[place].tag
                if self.stack[place].dropped:
                    break
                if own in ENDS and tag in ENDS[own]:
                    while len(self.stack) > place:
                        self.pop()
                    break
                if own in BLOCKS and (own not in ENDS or own in SCOPES.get(tag, ())):
                    break
        self.count += 1
        outer = self.stack[-1] if self.stack else None
        article = bool(outer and outer.article)
        names = frozenset(names_in(attributes)) if len(attributes) > 1 and tag not in ("html", "body") else frozenset()
        if tag == "a":
            self.links += 1
        own = bool(outer and outer.own) or tag == "article"
        self.stack.append(_Open(tag, self.count, article or self.heart(tag, names), outer, names, own))
        self.opened.append(self.stack[-1])

    def weigh(self) -> None:
        """What elements say of the text in them, once it is known how much of the page's text they hold."""
        for one in reversed(self.opened):
            if one.outer:
                one.outer.text += one.text
                one.outer.every += one.every
        whole = self.whole
        for one in reversed(self.opened):
            one.holds = one.holds or one.tag == "main" or self.heart(one.tag, one.names) and 4 * one.text >= whole
            if one.outer:
                one.outer.holds = one.outer.holds or one.holds
        for one in self.opened:
            self.judge(one, whole)
        for block in self.blocks:
            if block.holder:
                one = block.holder
                against = max(one.form, one.bad)
                block.inside = (min(one.good, 8.0) - against if against else one.good) - PENALTY * one.hidden
                block.in_article, block.in_listing = one.article and not against, one.listing and not against

    @classmethod
    def judge(cls, one: _Open, whole: int) -> None:
        tag, names, outer = one.tag, one.names, one.outer
        if outer:
            one.good, one.form, one.bad, one.hidden, one.listing = outer.good, outer.form, outer.bad, outer.hidden, outer.listing
        one.hidden = one.hidden or HIDDEN in names
        most = 2 * one.text > whole
        share = one.text / whole if whole else 0.0
        # what holds the main element or the article may be called anything: these speak for themselves
        scaled = PENALTY if one.holds else PENALTY * min(1.0, max(0.0, (FREE - share) / (FREE - FULL)))
        if cls.heart(tag, names):
            if tag == "article" and outer and outer.own and not most:  # a reader's
                one.bad = PENALTY
            else:
                one.good += 2.0 if tag == "main" else 6.0
                # what is around the main element or the article says nothing; a small one may be a teaser
                one.form, one.bad = 0.0, 0.0 if tag == "main" or 4 * one.text >= whole else one.bad
                one.listing = tag == "main" and one.text <= (1 - LISTING) * one.every
        elif tag == "form":
            one.form = max(one.form, scaled)
        elif tag in BOILERPLATE_TAGS or tag == "header" and not (outer and outer.article):
            one.bad = PENALTY
        elif names:
            around = bool(names & LAYOUT) and (most or one.holds)
            if "elementor" in names:  # there, every block is a widget
                names = names - {"widget"}
            called = {n for n in names if not LAYOUT_PARTS.search(n)} if around else names
            if cls.boilerplate(called):
                # readers may write more than the author
                one.bad = max(one.bad, PENALTY if cls.of_readers(called) else scaled)
            elif "header" in names and not (outer and outer.article) and not names & CONTENT_NAMES:
                one.bad = max(one.bad, scaled)
            if names & CONTENT_NAMES and not one.bad:
                one.good += 3.0

    @staticmethod
    def of_readers(names: Set[str]) -> bool:
        return bool(names & READERS_NAMES) or any(map(READERS_PARTS.search, names))

    @classmethod
    def heart(cls, tag: str, names: frozenset[str]) -> bool:
        return tag == "main" or tag == "article" and not cls.readers(names)

    @classmethod
    def readers(cls, names: Set[str]) -> bool:
        """Whether an article element's names speak against it; topics in a post's do not."""
        return HIDDEN in names or cls.boilerplate(names) and not names & ARTICLE_NAMES

    @staticmethod
    def boilerplate(names: Set[str]) -> bool:
        return HIDDEN in names or bool(names & BOILERPLATE_NAMES) or any(map(BOILERPLATE_PARTS.search, names))

    def pop(self) -> None:
        last = self.stack.pop()
        if last.tag == "a":
            self.links -= 1
        if last.dropped:
            self.dropped.pop()

    def close(self, tag: str) -> None:
        if tag in DROPPED and not self.dropped:
            return
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place].tag == tag:
                while len(self.stack) > place:
                    self.pop()
                return
            if tag not in BLOCKS and tag not in DROPPED and self.stack[place].tag in BLOCKS:
                return  # an inline end tag does not reach beyond its block


def _closed(html: str, tag: str, place: int) -> bool:
    """Whether an element has no end tag before the next of its kind: ``<tag/>`` is over, then."""
    after = re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).search(html, place)
    return not (after and after[1])


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in order, however broken its markup is."""
    page, place = _Page(), 0
    ends = {end[1].lower(): end.start() for end in DROPPED_ENDS.finditer(html)}
    found = TAG.search(html)
    while found:
        if found.start() > place:
            page.add(html[place : found.start()])
        place = found.end()
        tag = found[2]
        if tag:
            tag = tag.lower()
            block, over = tag in BLOCKS, found[0].endswith("/>")
            held = page.shown() if page.dropped else None
            if block and held is None:
                page.flush()
            if found[1]:
                page.close(tag)
            elif tag in ("svg", "math") and over or over and tag in RAW | DROPPED and _closed(html, tag, place):
                pass
            elif tag in DROPPED:
                page.drop(tag, not _closed(html, tag, place) if tag in SHORT else ends.get(tag, -1) >= place)
            elif over and page.dropped and not block:
                pass
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, place)
                place = end.end() if end else len(html)
            elif tag in EMPTY:
                if tag == "br":
                    page.add(" ")
            else:
                page.open(tag, found[3])
            if block and held is not None and not page.dropped:
                page.flush(held)
        found = TAG.search(html, place)
    rest = CUT_OFF.sub("", html[place:])
    if rest:
        page.add(rest)
    page.flush()
    page.weigh()
    return page.blocks


def gain(block: Block) -> float:
    """The classifier's evidence that a block is content, negative for boilerplate."""
    words = block.text.count(" ") + 1
    found = block.inside - 0.5 + min(words, 40) * 0.08 - (0.0 if block.in_listing else 4.0) * block.linked
    if block.tag in ("p", "blockquote", "pre", "h1", "h2", "h3"):
        found += 1.0
    if block.text[-1] in ".!?…:;\"'”»":
        found += 0.5
    if "©" in block.text[:3] or words < 30 and "all rights reserved" in block.text.lower():
        found -= 4.0
    return found


def gains(blocks: list[Block]) -> list[float]:
    """The evidence for all blocks; in an article, a list of links under a heading that leads elsewhere goes with it."""
    found = [gain(block) for block in blocks]
    for i, block in enumerate(blocks):
        if block.in_article and len(block.text) < 60 and ELSEWHERE.fullmatch(block.text):
            end = i + 1
            while end < len(blocks) and blocks[end].linked > 0.8:
                end += 1
            if end > i + 1:
                for k in range(i, end):
                    found[k] -= PENALTY
    return found


def edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in the text, the more the closer in the tree, and children of one element."""
    found, last = [], {}
    for i, block in enumerate(blocks):
        path = block.path
        if i:
            before = blocks[i - 1].path
            common = 0
            for x, y in zip(path, before):
                if x != y:
                    break
                common += 1
            found.append((i - 1, i, 2.0 / (1 + len(path) + len(before) - 2 * common)))
        parent = path[:-1]
        if parent in last:
            found.append((last[parent], i, 1.0))
        last[parent] = i
    return found


def main_text(html: str | None) -> tuple[str, int, int]:
    """The content blocks joined by line breaks, how many they are, and how many blocks there are."""
    blocks = blocks_of(html or "")
    content = minimum_cut(gains(blocks), edges(blocks))
    kept = [block.text for block, yes in zip(blocks, content) if yes]
    return "\n".join(kept), len(kept), len(blocks)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(row, text, n_content, n_blocks)``; ``row`` is a struct of all columns of ``pages``.

    ``text`` is the page's article: blocks between block-level tags, with character references
    decoded and white space as single spaces, one per line; empty if nothing is found or ``html`` is
    null. Scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms and comments
    are left out. Whole pages are read; nothing is cut off.
    """
    share_code(pages.sparkSession)

    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([main_text(value) for value in values], columns=["text", "n_content", "n_blocks"])

    found = F.pandas_udf(run, "text string, n_content int, n_blocks int")
    row = F.struct(*(column(pages, name) for name in pages.columns)).alias("row")
    return pages.select(row, found(column(pages, html).cast("string")).alias("found")).select("row", "found.*")
