"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies each block by itself:
containers of menus, adverts, comments and the like are boilerplate, as are blocks made of links, in an article only
``MENU_ITEMS`` list items in a row that are nothing but links; long blocks
with enough stop words, or in a script that has none here, are text; what is short or in between
stays open. The second pass gives open blocks the label of the nearest decided neighbours; on a page
without an article and without decided text, all blocks that are not boilerplate are text. In an article an open block is
text unless it stands between two menus, and containers say nothing about what is beside them. Pages are independent
rows: nothing is shuffled, and each task holds a batch of pages.

Containers are known by their tag, or by the parts of a class, id or role name. A name that ends in a boilerplate word is
one (``user-comments``); one that has it elsewhere is too (``comment-thread``), unless it also names content or
a state of the page (``content-sidebar-wrap``, ``has-sidebar``). Words with other meanings, such as ``share``, count
only by themselves or beside words of layout.

Defined results: null, empty or textless html gives an empty string; broken markup is read as far
as it goes, with unclosed tags closed at the end; repeated pages are read alike; extra columns are
kept, and one with the name of the result is replaced by it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Common function words by language.
STOP_WORDS = frozenset(
    """the of and to in a is that for it as was with be by on not he his but at are this have from or had
    an they which one you were all her she there would their we him been has when who will no more if out so
    der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er
    hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis
    de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son
    aux d l on mais nous vous ses leur cette elle être fait
    el y los del se las por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre
    cuando todo esta ser dos también fue había era muy años hasta desde
    il lo gli di che è non per una sono della del nel alla anche ma come più questo
    o os e do da em um uma não com para mais ao pelo seu sua
    het een van niet zijn dat op te voor met aan ook bij naar
    och att det som på är av för inte till ett jag w na się nie jest""".split()
)

BLOCK_TAGS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead title tr ul""".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Nothing in these is text of the page, and their content is not markup.
RAW_TAGS = frozenset("script style textarea xmp noembed noframes iframe title".split())
HIDDEN_TAGS = frozenset("head noscript template svg math select button object canvas audio video datalist".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog search".split())
TEXT_ROOTS = frozenset("article main".split())
#: Parts of a class, id or role name that name boilerplate wherever they stand.
CLEAR_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors cookie cookies
    gdpr popup sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer
    masthead toolbar newsletter comment comments commenting disqus contentinfo""".split()
)
#: Names that mean boilerplate by themselves or beside words of layout only.
OTHER_NAMES = frozenset(
    """banner promo promotion consent notice notices alert modal overlay widget widgets related recommended
    recommendations share sharing social subscribe subscription signup login respond reply replies skip copyright
    complementary""".split()
)
BOILER_NAMES = CLEAR_NAMES | OTHER_NAMES
#: Named elements that stay boilerplate around an article: its comments, menus and sidebars.
STRICT_NAMES = frozenset(
    """comment comments commenting respond reply replies disqus menu menus nav navbar navigation breadcrumb breadcrumbs
    pagination pager sidebar sidebars widget widgets related recommended recommendations complementary""".split()
)
#: Parts beside which such a name is about the text or the page, unless the name comes last.
CONTENT_NAMES = frozenset("article body content entry main page post story text".split())
STATE_NAMES = frozenset("has have no non not with without hide hidden show is open closed off on".split())
#: Words of layout.
QUALIFIERS = frozenset(
    """site main top bottom left right primary secondary global box block bar list links buttons section area slot
    unit form item items posts articles container wrapper wrap inner outer group""".split()
)
#: Names written as one word, such as adbox or commentlist.
GLUED = re.compile(
    r"(ads?|adv|advert|comments?|cookies?|sidebar|menu|nav|footer)"
    r"(area|bar|block|box|container|form|frame|holder|list|notice|panel|section|slot|space|thread|unit|wrap|wrapper|zone)s?"
)
PAGE_HEADERS = frozenset("header site-header page-header top-bar topbar".split())
PART = re.compile(r"[-_]+")
#: A quote in a tag matters only behind an equals sign.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
HIDDEN, WRAPPER, STRICT = "hidden", "wrapper", "strict"
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[^\W\d_]+")
#: Letters beyond the Latin ones, which no stop word has, and those of scripts that leave no space between words.
FOREIGN = re.compile(r"[^\W\d_\u0000-\u024f\u1e00-\u1eff]")
UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
UNSPACED_WORD = 2

LONG_WORDS = 12
MIN_STOP_SHARE = 0.08
MAX_LINK_SHARE = 0.4
#: List items in a row that make a menu in an article, and the share of links in each.
MENU_ITEMS = 3
MENU_SHARE = 0.9
GOOD, BAD, OPEN, LINKS = "text", "boilerplate", "open", "links"


class Block:
    """Text between two block-level tags. ``closed_off``: it stands for boilerplate, which has no text here."""

    __slots__ = ("tag", "in_root", "closed_off", "linked", "parts")

    def __init__(self, tag: str, in_root: bool, closed_off: bool = False):
        self.tag, self.in_root, self.closed_off, self.linked, self.parts = tag, in_root, closed_off, 0, []

    def text(self) -> str:
        return SPACE.sub(" ", "".join(self.parts)).strip()


def _named(value: str, in_root: bool) -> str:
    """What the names of a class, id or role value make of an element."""
    found = ""
    for name in value.split():
        parts = [part for part in PART.split(name) if part]
        parts = [GLUED.fullmatch(part).group(1) if GLUED.fullmatch(part) else part for part in parts]
        known = BOILER_NAMES.intersection(parts)
        if not known:
            if not in_root and name in PAGE_HEADERS:
                found = WRAPPER
            continue
        plain = QUALIFIERS.union(known).issuperset(parts)  # nothing but its words and words of layout
        clear = CLEAR_NAMES.intersection(known) and not STATE_NAMES.intersection(parts)
        if plain or (clear and (parts[-1] in CLEAR_NAMES or not CONTENT_NAMES.intersection(parts))):
            if known & STRICT_NAMES:
                return STRICT
            found = WRAPPER
    return found


def _marked(attributes: str, tag: str, in_root: bool) -> str:
    """Whether attributes hide an element or name it as boilerplate, strictly or up to an article inside.

    An article or main is hidden by its attributes only, never named.
    """
    found = ""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HIDDEN
        if name in ("class", "id", "role") and tag not in TEXT_ROOTS and found != STRICT:
            found = _named(value, in_root) or found
    return found


def blocks(page: str) -> Iterator[Block]:
    """The text blocks of a page in order, with a mark wherever boilerplate was left out."""
    stack: list[tuple[str, bool, str, bool]] = []  # tag, then hidden, boilerplate tag, text root around it
    hidden, boiler, root, links = False, "", False, 0
    block, left_out, at = Block("", False), False, 0

    def text(raw: str) -> None:
        nonlocal left_out
        if hidden or not raw:
            return
        if boiler:
            left_out = True
            return
        raw = html.unescape(raw) if "&" in raw else raw
        block.parts.append(raw)
        if links:
            block.linked += len(SPACE.sub("", raw))

    while token := TOKEN.search(page, at):
        text(page[at : token.start()])
        at = token.end()
        tag = (token.group(2) or "").lower()
        if tag == "br":
            text(" ")
        if not tag or tag == "br":
            continue
        if tag in BLOCK_TAGS:
            if block.parts:
                yield block
            if left_out:
                yield Block(tag, root, closed_off=True)
                left_out = False
        attributes = token.group(3)
        if token.group(1):
            if any(entry[0] == tag for entry in stack):
                while True:
                    name, hidden, boiler, root = stack.pop()
                    links -= name == "a"
                    if name == tag:
                        break
        elif tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID_TAGS and not attributes.endswith("/"):
            if tag in ("p", "li", "a") and stack and stack[-1][0] == tag:  # left open before
                _, hidden, boiler, root = stack.pop()
                links -= tag == "a"
            links += tag == "a"
            stack.append((tag, hidden, boiler, root))
            hidden = hidden or tag in HIDDEN_TAGS
            if tag in TEXT_ROOTS and boiler in ("", WRAPPER):  # a form or a named wrapper may hold the whole page
                root, boiler = True, ""
            marked = _marked(attributes, tag, root) if attributes and tag not in ("html", "body") else ""
            if marked in (HIDDEN, STRICT) or (tag in BOILER_TAGS and tag != "form") or (tag == "header" and not root):
                boiler = STRICT
            elif marked or tag == "form":
                boiler = boiler or WRAPPER
        if tag in BLOCK_TAGS:
            block = Block(tag, root)
        elif not block.parts:
            block.in_root = root
    text(page[at:])
    if block.parts:
        yield block


def first_pass(block: Block, text: str, has_root: bool) -> str:
    """The label of a block by itself."""
    if block.closed_off:
        return BAD
    solid = len(text) - text.count(" ")
    if has_root and block.tag == "li" and block.linked > MENU_SHARE * solid:
        return LINKS
    if not has_root and block.linked > MAX_LINK_SHARE * solid:
        return BAD
    if not has_root and text.startswith("©"):
        return BAD
    words = WORD.findall(text.lower())
    if not text.isascii():
        length = len(words) + len(UNSPACED.findall(text)) // UNSPACED_WORD
        letters = sum(map(len, words))
        if length >= LONG_WORDS and 2 * len(FOREIGN.findall(text)) > letters:
            return GOOD
    if len(words) < LONG_WORDS:
        return OPEN
    stops = sum(word in STOP_WORDS for word in words)
    return GOOD if stops >= MIN_STOP_SHARE * len(words) else OPEN


def menus(labels: list[str]) -> list[str]:
    """Link items of an article: boilerplate where enough stand in a row, open elsewhere."""
    found = []
    for label, run in groupby(labels):
        size = len(list(run))
        found += [(BAD if size >= MENU_ITEMS else OPEN) if label == LINKS else label] * size
    return found


def second_pass(labels: list[str], has_root: bool) -> list[str]:
    """Open blocks inherit from the nearest decided block on either side.

    Two equal neighbours decide at once. Between different ones the nearer wins, and text wins a
    tie. Without a decided neighbour, open blocks are boilerplate. In an article only two neighbours that are
    boilerplate both make an open block boilerplate.
    """
    last: list[tuple[int, str] | None] = []
    seen = None
    for i, label in enumerate(labels):
        last.append(seen)
        if label != OPEN:
            seen = (i, label)
    found = list(labels)
    seen = None
    for i in range(len(labels) - 1, -1, -1):
        if labels[i] != OPEN:
            seen = (i, labels[i])
            continue
        left, right = last[i], seen
        if has_root:
            found[i] = BAD if left and right and left[1] == right[1] == BAD else GOOD
        elif left and right and left[1] != right[1]:
            near, far = i - left[0], right[0] - i
            found[i] = GOOD if near == far else (left if near < far else right)[1]
        elif left or right:
            found[i] = (left or right)[1]
        else:
            found[i] = BAD
    return found


def main_text(page: str | None) -> str:
    """The blocks of the main text, joined by an empty line."""
    found = [(block, text) for block in blocks(page or "") if (text := block.text()) or block.closed_off]
    has_root = any(block.in_root and text for block, text in found)
    if has_root:  # only the article counts, and what was left out of it says nothing about its neighbours
        found = [(block, text) for block, text in found if block.in_root and not block.closed_off]
    labels = menus([first_pass(block, text, has_root) for block, text in found])
    if not has_root and GOOD not in labels:  # short or in another language: length and links decide alone
        labels = [GOOD if label == OPEN else label for label in labels]
    labels = second_pass(labels, has_root)
    return "\n\n".join(text for (_, text), label in zip(found, labels) if label == GOOD)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """The rows of ``pages`` with the main text in place of the html."""

    @F.pandas_udf(StringType())
    def read(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    others = [name for name in pages.columns if name not in (html_col, text_col)]
    return pages.select(*others, read(html_col).alias(text_col))
