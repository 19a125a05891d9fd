"""Main text of web pages: flat text blocks, classified by a decision tree trained on a small labelled table.

A page is cut at block-level tags into flat blocks of text. A block's features are its number of words and link density
(share of its words inside links), the same of the block before and after it, and what the markup says: whether it lies
in an article or main element, in an element for something else (2 by tag, or called a comment or hidden; 1 by another class,
id or role), and whether it is a heading. A CART tree trained on ``PAGES`` tells article from the rest. Its table holds each
page in several layouts, and each block four times: with all markup, without article and main, without any but headings, and
without any. So words and links decide wherever markup is silent, and long blocks among long ones outvote a class.

A class, id or role names something else if its last word does ("post-sidebar", "share-buttons"), unless it tells of what is
beside it ("has-sidebar"); what article and main elements are called themselves doesn't count, but for comments.

Text is kept as it is but for character references, which are decoded, and white space, which becomes one space; a line
break element is white space. Script, style and other elements without running text are skipped, to their end tag; one
that has no end tag is skipped itself only, and a head without one ends at the first element that can't be in it. Markup
needn't be well-formed: elements may be left open, tags may be unquoted or cut off.

Results for special cases: a null or empty page has an empty text of 0 characters; repeated rows give repeated results;
an empty table gives an empty one; other columns are dropped. Nothing is kept but one page at a time and its blocks.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of HTML elements and of what classes, ids and roles call them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
INLINE |= frozenset("math mfrac mi mn mo mover mroot mrow ms mspace msqrt msub msubsup msup mtext munder object semantics".split())
SPACE = frozenset("br img hr wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = frozenset("head noscript template svg select button video audio canvas map datalist".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
CHROME = frozenset("nav header footer aside form menu dialog".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social footer header masthead topbar toolbar login signup subscribe newsletter "
    "pagination pager tags search complementary contentinfo".split()
)
LASTING = frozenset("comment comments commentlist disqus discussion replies reply respond hidden".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|([^<]+|<)""",
    re.S,
)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
CONCEALED = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
#: The end tags of elements that are left out as a whole.
ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW | SKIPPED}
WORDS = re.compile(r"[A-Za-z]+")
#: Words of a class that tell of what is beside the element, and last words that tell nothing; fixed values.
BESIDE = frozenset("has have with without no not hide show is on off".split())
EMPTY = frozenset("area bar block bottom box button buttons container group icons inner item items left links list panel right row section slot top unit wrap wrapper".split())
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: The labelled table: a page on each line, its blocks as kind, words, and, after a slash, link density in percent (if not 0,
#: or 100 for a menu). Kinds: h heading and p text of the article; n menu, a notice, advert or site header, o form, s sidebar,
#: c reader comment, t heading of any of these, f footer. The first lines are real pages, the others of our own making.
PAGES = """
n1 n1 n1 n1 n1 n1 a4 h9 p9 p135 p45 p23 p10 f13
n1 n1 n1 n1 n1 n1 a8 h9 p9 p61 p106 p29 p7 p39 p2 p6 p1 f13
n1 n1 n1 n1 n1 n1 a5 h9 p28 p57 p127 p72 p132 p16 p10 p118 p77 p19 p72 p76 p54 p2 p16 p1 p231 p46 p8 p19 p45 p54 p39 f10
n1 n1 n1 n1 n1 n1 a8 h7 p7 p25 p24 p3 p4 f13
n1 n1 n1 n1 n1 n1 a11 h12 p33 p95 p66 p2 p19 p6 p10 p16 p9 p23 p38 p42 p115 p17 p36 p63 p4 p157 p5 p71 f12
n1 n1 n1 n1 n1 n1 a9 h10 p50 p122 p142 f12
n1 n1 n1 n1 a6 h13 p25 p20 p10 p20 f15
n1 n1 n1 n1 n1 n1 a9 h8 p8 p17 p33 p29 p15 p53 p10 p33 p94 p64 p21 p66 p40 p16 p22 p8 p45 p62 p62 p12 p35 p13 p33 p13 f7
n1 n1 n1 n1 n1 n1 a10 h8 p8 p2 p62 p23 p5 p8 f14
n1 n1 n1 n1 n1 n1 a11 h12 p122 p40 p20 p92 p19 p11 p3 p70 p52 p14 p18 p31 p8 p3 p9 f10
n1 n1 n1 n1 n1 n1 a8 h7 p7 f11
n1 n1 n1 n1 n1 a7 h8 p114 p50 p17 p23 p6 p104 p62 p36 f12
n1 n1 n1 n1 n1 n1 a11 h12 p122 p40 p20 p92 p19 p11 p3 p70 p52 p14 p18 p31 p8 p3 p9 f10
n1 n1 n1 n1 n1 n1 a4 h11 p18 p10 p27 p133 p8 p1 p37 p57 p96 p56 p47 p50 p109 p2 f8
n1 n1 n1 n1 n1 n1 a5 h10 p17 p29 p30 f12
n1 n1 n1 n1 n1 n1 a4 h9 p27 p31 p31 p31 p31 p4 f9
n1 n1 n1 n1 n1 n1 a7 h10 p17 p29 p30 f16
n1 n1 n1 n1 n1 n1 a10 h12 p110 p7 f10
n1 n1 n1 n1 n1 n1 a9 h9 p150 p9 f11
n1 n1 n1 n1 n1 n1 a6 h11 p11 p4 p99 p31 p4 p101 p5 p11 p2 p24 p52 p33 p55 p28 f13
n1 n1 n1 n1 n1 n1 a10 h9 p12 p8 p3 p38 p36 p28 p6 p25 p102 p80 p60 p21 p33 p63 f10
n1 n1 n1 n1 n1 n1 a9 h10 p63 p18 p113 p11 p23 p7 p3 p3 p2 p40 p34 p22 p12 f7
n1 n1 n1 n1 a6 h11 p50 f15
n1 n1 n1 n1 n1 n1 a9 h4 p4 p80 p24 p60 p16 p28 p25 p10 f15
n1 n1 n1 n1 n1 n1 a8 h7 p7 p25 p24 p3 p4 f13
n1 n1 n1 n1 n1 n1 a7 h9 p9 p79 p9 f15
n1 n1 n1 n1 n1 n1 a8 h3 p3 p144 f8
n1 n1 n1 n1 n1 n1 a4 h11 p83 p99 p62 p87 p2 f8
a3 n1 n2 n1 n2 a18/10 h11 p60 p45/8 h4 p80 p35/60 p20/15 t2 n6 n7 n5 t1 c20 c45 c8 f9 n1 n2 n2 f6
n2 n2 n3 h8 p22 p18/30 p150/4 p9/100 p70 s3/100 s4/100 s6/100 f20
a2/100 n1 n1 n1 n1 a12 o5 h6 p40 p3 p12 p30 p1 t3 s8/90 s9/100 s7/100 f4 n2 n2 n1 f12
n1 n1 n1 h14 p5 p90 p60 p2/100 p55 h3 p40 p25 a9 p65 p80 t2 n5 n8 n6 f30/20 n1 n1
a25/8 a4 n1 n1 n2 h9 p35 p110/3 a14 p95 p48 o8 o2 t1 c30 c12 c60 c5 f16
h10 p75 p120 p30
n1 n2 n1 n1 a6/50 h7 p28 p14 p52/12 p33 p41 s2/100 s3/100 s2/100 t4 n9 n7 f7
a3/100 n1 n1 n1 t2 s4/100 s5/100 s3/100 h12 p66 p58 p7 p77 f11 n1 n1
n1 n1 n1 n1 n1 a10 a22 h5 p18 p44 p9/25 p160 p12 f8/30
a21 h4 p21 p21 s1/100 s1/100
p400
h8 p900 f12
p60
a30 n1 n1 h6 p35 p28 p19 n1 n1 n2
h8 p25 p14 p31 s2/100 s3/100
n1 n1 h5 p22 p24 p18
n2 n1 n2 h9 p200/20 p90 p40 o4 o12 f5 n2 n3
p2
p5
p9
p20
h4 p5
h3 p12 p30
a1
"""


def layouts(page: list[tuple]) -> list[list[tuple]]:
    """The page as it is, with menus of two and three words, with a menu of one line, without menus, without adverts, without
    what comes before the article, after it, and both."""
    own = [i for i, (kind, *_) in enumerate(page) if kind in "hp"]
    if not own:
        return [page] * 9
    first, last = own[0], own[-1] + 1
    longer = lambda k: [(kind, words + k, links) if kind == "n" else (kind, words, links) for kind, words, links in page]
    menu = sum(words for kind, words, _ in page[:first] if kind == "n")
    line = [("n", menu, 1.0)] * (menu > 0) + [c for i, c in enumerate(page) if c[0] != "n" or i >= first]
    without = lambda kinds: [c for c in page if c[0] not in kinds]
    return [page, longer(1), longer(2), line, without("n"), without("a"), page[first:], page[:last], page[first:last]]


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the table's blocks. Comments are like article text but for their markup, so without that they
    are no example of either."""
    x, y = [], []
    pages = [[(c[0], *map(int, c[1:].split("/"))) for c in line.split()] for line in PAGES.split("\n") if line]
    pages = [[(k, n, (v[0] if v else 100 * (k == "n")) / 100) for k, n, *v in cells] for cells in pages]
    edge = ("", 0, 0.0)
    for page in [variant for page in pages for variant in layouts(page)]:
        for before, (kind, words, links), after in zip([edge, *page], page, [*page[1:], edge]):
            own = int(kind in "hp")
            for main, chrome, heading in ((1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0)):
                for level in (1, 2) if chrome and not own else (chrome,):
                    if kind != "c" or level == 2:
                        x.append((words, links, *before[1:], *after[1:], own * main, level * (1 - own), heading * (kind in "ht")))
                        y.append(own)
            # inside an article element, markup tells both ways: short blocks as these are stand there, too
            x += [(words, links, *before[1:], *after[1:], 1, chrome, int(kind in "ht")) for chrome in (0, 1, 2)]
            y += [1, 0, 0]
    # long text among long text is the article's, whatever class it has
    for words, before, after, links in itertools.product((60, 90, 150, 300), (25, 45, 80, 160), (25, 45, 80, 160), (0.0, 0.05)):
        x += [(words, links, before, links, after, links, main, 1, 0) for main in (0, 1)] * 12
        y += [1, 1] * 12
    return np.array(x, float), np.array(y)


class Tree:
    """CART with the Gini impurity; nested tuples (feature, cut, below or equal, above), leaves are labels. A leaf has
    ``least`` examples or more."""

    def __init__(self, depth: int = 8, least: int = 8):
        self.depth, self.least, self.root = depth, least, 0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Tree:
        self.root = self._grow(x, y, self.depth)
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        label = int(2 * y.sum() > len(y))
        if depth == 0 or y.min() == y.max():
            return label
        best = (len(y) * self._gini(y) - 1e-9, None, None)
        for feature in range(x.shape[1]):
            values = np.unique(x[:, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, feature] <= cut
                if not self.least <= left.sum() <= len(y) - self.least:
                    continue
                impurity = left.sum() * self._gini(y[left]) + (~left).sum() * self._gini(y[~left])
                if impurity < best[0] - 1e-9:
                    best = (impurity, feature, cut)
        _, feature, cut = best
        if feature is None:
            return label
        left = x[:, feature] <= cut
        return (feature, float(cut), self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1))

    @staticmethod
    def _gini(y: np.ndarray) -> float:
        p = y.mean()
        return 2 * p * (1 - p)

    def predict(self, row: tuple[float, ...]) -> int:
        node = self.root
        while isinstance(node, tuple):
            feature, cut, below, above = node
            node = below if row[feature] <= cut else above
        return node


class Block:
    __slots__ = ("text", "words", "links", "main", "chrome", "heading")

    def __init__(self, text: str, words: int, links: float, main: int, chrome: int, heading: int):
        self.text, self.words, self.links, self.main, self.chrome, self.heading = text, words, links, main, chrome, heading


def _says(attributes: str) -> tuple[bool, bool]:
    """Whether class, id or role name something other than the article; whether that holds for articles inside, too."""
    if not attributes:
        return False, False
    hint = lasting = False
    for value in NAMED.findall(attributes):
        for name in value.strip("\"'").split():
            words = [w.lower() for w in WORDS.findall(CAMEL.sub(" ", name))]
            while len(words) > 1 and words[-1] in EMPTY:
                words.pop()
            if words and BESIDE.isdisjoint(words):
                hint |= words[-1] in HINTS
                lasting |= words[-1] in LASTING
    return hint, lasting or bool(CONCEALED.search(attributes))


def blocks(page: str) -> list[Block]:
    """The page's flat text blocks in order."""
    found: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    in_link = heading = skip = 0
    skipped = ""
    stack: list[tuple[str, int, int, int]] = []  # name; main, chrome and lasting from here on
    main = chrome = lasting = 0

    def flush() -> None:
        nonlocal parts, linked
        words = "".join(parts).split()
        if words:
            found.append(Block(" ".join(words), len(words), min(1.0, len("".join(linked).split()) / len(words)), main, 2 if lasting else chrome, int(heading > 0)))
        parts, linked = [], []

    missing: set[str] = set()  # names with no end tag further on

    def ends(name: str, at: int) -> re.Match | None:
        close = ENDS[name].search(page, at) if name not in missing else None
        if close is None:
            missing.add(name)
        return close

    at, end, match = 0, len(page), TOKEN.match
    while at < end:
        token = match(page, at)
        at = token.end()
        if text := token[7]:
            if not skip:
                text = entities.unescape(text)
                parts.append(text)
                if in_link:
                    linked.append(text)
            continue
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing, attributes = token[1] or token[4], token[3] or token[6] or ""
        if name in RAW and not closing:
            close = ends(name, at)
            if close:
                at = close.end()
            elif name != "title":  # the rest is no text
                at = end
            continue
        if skip:
            if name == skipped:
                skip += -1 if closing else 0 if attributes.endswith("/") else 1
            elif skipped == "head" and not closing and name not in IN_HEAD:
                skip = 0
            if skip or closing:
                continue
        if name in SKIPPED:
            if not closing and not attributes.endswith("/") and (name == "head" or ends(name, at)):
                flush()
                skip, skipped = 1, name
            continue
        if name == "a":
            in_link = 0 if closing else 1
            if in_link and linked:
                linked.append(" ")
            continue
        if name in SPACE:
            parts.append(" ")
            if in_link:
                linked.append(" ")
            continue
        if name in INLINE or name in VOID:
            continue
        flush()
        in_link = 0
        if len(name) == 2 and name[0] == "h" and name[1].isdigit():
            heading = 0 if closing else 1
        elif name == "p":
            heading = 0
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    _, main, chrome, lasting = stack[i]
                    del stack[i:]
                    break
        elif name not in ("p", "li", "tr", "td", "th", "dt", "dd", "option", "html") or attributes:
            hint, last = _says(attributes)
            stack.append((name, main, chrome, lasting))
            if name in MAIN:
                main, chrome = 1, 0
            elif name in CHROME and not (name == "header" and main):
                chrome = 2
            elif hint and not heading and name != "body":
                chrome = max(chrome, 1)
            if last:
                lasting = 1
    flush()
    return found


def rows_of(found: list[Block]) -> Iterator[tuple[float, ...]]:
    edge = Block("", 0, 0.0, 0, 0, 0)
    for before, own, after in zip([edge, *found], found, [*found[1:], edge]):
        yield (own.words, own.links, before.words, before.links, after.words, after.links, own.main, own.chrome, own.heading)


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    return "\n".join(block.text for block, row in zip(found, rows_of(found)) if tree.predict(row))


def extract(pages: DataFrame, html: str = "html", id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree().fit(*labelled())
        for batch in batches:
            texts = [main_text(v.as_py(), tree) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
