"""Main-text extraction from raw HTML by text-to-tag ratios.

The standard library's streaming parser gives events; block-level tags end a line.  Each line has
the ratio of its text to its tags.  The ratios are smoothed with a Gaussian over neighbouring lines, so that
headings and short paragraphs gain from the text around them and long lines among menus lose.  A line's
score is the logarithm of its smoothed ratio, times the share of its text outside links (a tenth at least), times a prior
from names of tags and classes (a menu, a notice or a reader comment counts a twentieth or a tenth); a
two-means threshold clusters the scores into content and other lines.  A name counts as a whole word or a compound of such
words; a name that covers nearly all of a page's text says nothing about it, and within an article a long text without links
outweighs the weaker names.

Regions.  The content region is the smallest block that holds all lines of the content cluster, or the
article, main part or block named as content around it.  All its lines stay, short ones and lists of links too, but for those
whose prior is less than half of the region's.  A main part or body whose content lies
in several of its blocks keeps the blocks with content, and the lines between them.
"""

from __future__ import annotations

import functools
import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose text is never content.
SILENT = frozenset("script style template noscript svg math iframe object canvas select textarea button option datalist audio video head title".split())
FURNITURE = frozenset("nav footer aside form dialog menu".split())
#: Block-level elements: their start and end separate lines.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html"
    " legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that may stand in a head; any other ends it.
IN_HEAD = frozenset("html head title base link meta style script noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Names of furniture, in classes, identifiers and roles.  Those of the first kind stand for what is never content; a long text without links
#: outweighs one of the second kind within an article.
HARD = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promos promotion promotions cookie cookies consent gdpr notice notices alert popup modal overlay"
    " sidebar aside comment comments commentlist respond disqus replies reply nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer newsletter subscribe"
    " contentinfo complementary".split()
)
SOFT = frozenset("widget share sharing social related recommend recommended recommendations signup login search skip toolbar".split())
#: Those of page headers; an article's own header is content.
HEADERS = frozenset("masthead header topbar".split())
#: Those that also count on elements within a line, whose text is then a line of its own.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion promotions".split())
COMMENTS = frozenset("comment comments commentlist respond disqus replies reply".split())
#: Within these an article is what they are: a reader's comment, a teaser.
HOLDING = COMMENTS | ADVERTS | frozenset("sidebar aside nav navbar navigation menu footer complementary contentinfo".split())
#: What a name of furniture may be joined with: cookie-notice, site-footer, ad_slot_3.  Any other word makes it another name: search-algorithms, menu-costs.
WITH = frozenset(
    "site page top bottom left right primary secondary global section list box block bar container wrapper wrap area panel item items link links inner outer text form policy button buttons"
    " slot unit group main header head body title author meta content post posts article articles news entry side wide mobile desktop sticky fixed floating small large icons icon count thread tree reader readers user".split()
)
#: A name that begins with one of these says how something else is laid out: has-sidebar, no-comments.
LAYOUT = frozenset("has no with without is not hide show have".split())
#: A text of so many characters without links, in a block of the second kind within an article, is content.
LONG_TEXT = 140


@functools.lru_cache(4096)
def furniture(words: str) -> frozenset[str]:
    """Names of furniture among the words of classes, identifiers and roles.

    A word counts as a whole ("sidebar", "side-bar") or as a compound of nothing but such names and words of ``WITH``, if it does not begin with one of ``LAYOUT``.
    """
    found = set()
    for word in words.split():
        whole = re.sub(r"[-_]", "", word).lower()
        if whole in HARD or whole in SOFT or whole in HEADERS:
            found.add(whole)
            continue
        parts = [p.lower() for p in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_A-Za-z]+", word)]
        names = [p for p in parts if p in HARD or p in SOFT or p in HEADERS]
        if names and parts[0] not in LAYOUT and all(p in WITH for p in parts if p not in names):
            found.update(names)
    return frozenset(found)


#: Class, id, role and property words of content.
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|articlebody|post|entry|content|story|main|maincontent)(?:$|[\s_-])")
#: A new start tag of the first kind ends an open element of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SIGMA = 1.0
#: Priors: of furniture tags, of furniture names, and the least that a page's content may have.
TAG_PRIOR, NAME_PRIOR, LEAST_PRIOR = 0.05, 0.1, 0.2
#: Clusters whose centres (logarithms) are nearer than this are one.
APART = 1.5
#: The share of a page's text outside links that a block with a name of furniture cannot have.
MOST_TEXT = 0.8


class Line:
    """A block's text: its pieces, tags, characters in links, the block it stands in, its prior."""

    __slots__ = ("parts", "tags", "linked", "node", "prior", "soft", "at")

    def __init__(self, node: int, prior: float, soft: float, at: int):
        self.parts, self.tags, self.linked, self.node, self.prior, self.soft, self.at = [], 0, 0, node, prior, soft, at

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Open:
    """An open element; what holds for it and all around it."""

    __slots__ = ("tag", "node", "silent", "prior", "named", "resume", "holding", "soft")

    def __init__(self, tag: str, node: int, silent: bool, prior: float, named: bool, resume: Line | None, holding: bool, soft: float):
        self.tag, self.node, self.silent, self.prior, self.named, self.resume = tag, node, silent, prior, named, resume
        #: Whether an article in it stays what it is; and the prior without names of the second kind, of use within an article.
        self.holding, self.soft = holding, soft


class LineParser(HTMLParser):
    """Parser events into lines, and the blocks they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        #: Blocks: tag, block around it (a smaller number), prior, whether named as content, whether a name of furniture may be taken back.
        self.blocks: list[tuple[str, int, float, bool, bool]] = [("html", -1, 1.0, False, False)]
        self.depth = {"p": 0, "a": 0, "head": 0, "article": 0, "main": 0}
        self.line = Line(0, 1.0, 1.0, 0)
        self.made = 0

    def _fresh(self) -> None:
        top = self.open[-1] if self.open else None
        self.made += 1
        self.line = Line(top.node if top else 0, top.prior if top else 1.0, top.soft if top else 1.0, self.made)

    def _break(self) -> None:
        if self.line.parts and not "".join(self.line.parts).isspace():
            self.lines.append(self.line)
        self._fresh()

    def _prior(self, tag: str, attrs: list[tuple[str, str | None]], block: bool) -> tuple[float, bool, frozenset[str]]:
        """(prior of an element's text, whether it is named as content, its names of furniture)."""
        around = self.open[-1].prior if self.open else 1.0
        words, hidden = "", False
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop") and value:
                words += f" {value}"
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and re.search(r"display\s*:\s*none", value)):
                hidden = True
        names = furniture(words) if words else frozenset()
        if hidden:
            return around * TAG_PRIOR, False, HOLDING
        if tag in ("html", "body"):
            return around, False, frozenset()
        inside = self.depth["article"] or self.depth["main"]
        good = tag in ("article", "main") or bool(words and block and CONTENT.search(words.lower()))
        if tag in ("article", "main") and not names & COMMENTS:
            held = any(o.tag in FURNITURE - {"form"} or o.holding for o in self.open)
            return (around if held else max(around, 0.5)), not held, frozenset()
        if tag in FURNITURE or (tag == "header" and not inside):
            return around * TAG_PRIOR, False, names
        names = names & ADVERTS if not block else names - HEADERS if inside else names
        if names:
            if good and not names & COMMENTS:
                return around * 0.5, True, names
            return around * NAME_PRIOR, False, names
        return around, good, names

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.depth["head"] and tag not in IN_HEAD:
            self._close("head")
        if tag == "br":
            self.line.parts.append(" ")
        if tag in VOID:
            self.line.tags += 1
            if tag == "hr":
                self._break()
            return
        block = tag in BLOCKS
        if block:
            if self.depth["p"]:
                self._close("p", limit=BLOCKS - {"p"})
            for old in CLOSES.get(tag, ()):
                self._close(old, limit={"ul", "ol", "dl", "table", "select"})
        prior, named, names = self._prior(tag, attrs, block)
        top = self.open[-1] if self.open else None
        around = top.prior if top else 1.0
        soft = prior if named or not (names and names <= SOFT and (self.depth["article"] or self.depth["main"])) else around
        if top and soft == prior and prior == around:
            soft = top.soft  # nothing new is said
        node, silent = (top.node, top.silent) if top else (0, False)
        if block:
            self.blocks.append((tag, node, prior, named, prior < around and bool(names) and tag not in FURNITURE and not names & COMMENTS))
            node = len(self.blocks) - 1
        resume = self.line if not block and prior < (top.prior if top else 1.0) else None
        holding = (top.holding if top else False) or bool(names & HOLDING) and not named
        self.open.append(Open(tag, node, silent or tag in SILENT, prior, named, resume, holding, soft))
        if tag in self.depth:
            self.depth[tag] += 1
        if block:
            self._break()
        elif resume is not None:
            self._fresh()
        self.line.tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends only void elements

    def _close(self, tag: str, limit: frozenset | set = frozenset()) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                gone = self.open[k:]
                del self.open[k:]
                resume = None
                for o in gone:
                    if o.tag in self.depth:
                        self.depth[o.tag] -= 1
                    resume = resume or o.resume
                if any(o.tag in BLOCKS for o in gone):
                    self._break()
                    if resume is not None and resume.parts:
                        self.lines.append(resume)
                elif resume is not None:
                    self._break()
                    self.line = resume
                    resume.parts.append(" ")
                return
            if self.open[k].tag in limit:
                return

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        if tag not in VOID:
            # an inline end tag doesn't reach through the block it stands in
            self._close(tag, limit=frozenset() if tag in BLOCKS else BLOCKS)
            if tag in BLOCKS and self.line.parts:
                self._break()

    def handle_data(self, data: str) -> None:
        if self.depth["head"] and self.open and self.open[-1].tag == "head" and not data.isspace():
            self._close("head")
        if not (self.open and self.open[-1].silent):
            self.line.parts.append(data)
            if self.depth["a"]:
                self.line.linked += len("".join(data.split()))

    def finish(self) -> list[tuple[Line, str]]:
        """The lines with text, in page order."""
        if self.rawdata.startswith("<!--"):  # a comment without end hides the rest
            self.rawdata = ""
        self.close()
        while self.open:
            self._close(self.open[-1].tag)
        self._break()
        out = sorted(((x, t) for x in self.lines if (t := x.text())), key=lambda x: x[0].at)
        for x, t in out:
            if not x.linked and len(t) >= LONG_TEXT:
                x.prior = x.soft
        return out


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; weights at the ends are those of the lines there are."""
    r = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-r, r + 1)]
    out = []
    for i in range(len(values)):
        a, b = max(0, i - r), min(len(values), i + r + 1)
        w = kernel[a - i + r : b - i + r]
        out.append(sum(x * y for x, y in zip(values[a:b], w)) / sum(w))
    return out


def two_means(scores: list[float]) -> float | None:
    """The threshold between two clusters; none if these are one."""
    low, high = min(scores), max(scores)
    for _ in range(30):
        cut = (low + high) / 2
        a, b = [x for x in scores if x <= cut], [x for x in scores if x > cut]
        if not a or not b:
            break
        new = (sum(a) / len(a), sum(b) / len(b))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low >= APART else None


def content_lines(lines: list[tuple[Line, str]]) -> list[bool]:
    """Whether each line is of the content cluster."""
    ratio = smooth([len(t) / max(1, x.tags) for x, t in lines])
    scores = [x.prior * (1 - 0.9 * min(1.0, x.linked / len(t))) * math.log1p(r) for (x, t), r in zip(lines, ratio)]
    cut = two_means(scores)
    if cut is None:  # the texts don't differ: the names alone decide
        most = max(x.prior for x, _ in lines)
        return [x.prior >= 0.5 * most for x, _ in lines]
    return [s >= cut for s in scores]


def lift_names(blocks: list[tuple[str, int, float, bool, bool]], lines: list[tuple[Line, str]]) -> None:
    """Take back the name of a block that has nearly all of the text outside links, where nothing is named as content.

    Comments, and what its tag says is furniture, stay what they are.
    """
    if not any(may for *_, may in blocks) or any(named for _, _, _, named, _ in blocks):
        return
    mass = [0] * len(blocks)
    for x, t in lines:
        mass[x.node] += max(0, len(t) - x.linked)
    for k in range(len(blocks) - 1, 0, -1):
        mass[blocks[k][1]] += mass[k]
    chain = {0: 1.0}  # blocks, and what their priors are to be divided by
    for k, (_, up, prior, _, may) in enumerate(blocks[1:], 1):
        taken = may and mass[k] >= MOST_TEXT * mass[0]
        chain[k] = chain[up] * (prior / blocks[up][2] if taken else 1.0)
    if all(v == 1.0 for v in chain.values()):
        return
    for x, _ in lines:
        factor = chain[x.node]
        x.prior, x.soft = min(1.0, x.prior / factor), min(1.0, x.soft / factor)


def region_lines(blocks: list[tuple[str, int, float, bool, bool]], lines: list[tuple[Line, str]], content: list[bool]) -> list[str]:
    """The texts of the content region."""
    total = sum(content)
    held = [0] * len(blocks)
    for (x, _), c in zip(lines, content):
        held[x.node] += c
    for k in range(len(blocks) - 1, 0, -1):
        held[blocks[k][1]] += held[k]
    region = max(k for k, n in enumerate(held) if n == total)  # the deepest: numbers grow inwards along its one chain
    spread = blocks[region][0] in ("html", "body", "main")
    around = region
    while around >= 0:
        if blocks[around][0] in ("article", "main") or blocks[around][3]:
            region, spread = around, spread or blocks[around][0] == "main"
        around = blocks[around][1]
    # the block of the region that each block stands in; 0 outside
    part = [0] * len(blocks)
    for k in range(region + 1, len(blocks)):
        up = blocks[k][1]
        part[k] = k if up == region else part[up]
    inside = [k for k, c in enumerate(content) if c]
    first, last = inside[0], inside[-1]
    out = []
    for k, (x, t) in enumerate(lines):
        if x.node != region and not part[x.node] or not content[k] and x.prior < 0.5 * blocks[region][2]:
            continue
        if spread and not content[k]:
            own = x.node == region or not held[part[x.node]]
            between = first < k < last or blocks[region][0] == "main" and x.linked < 0.5 * len(t)
            if own and not between:
                continue
        out.append(t)
    return out


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks in order, joined by line feeds."""
    if not html:
        return ""
    parser = LineParser()
    for i in range(0, len(html), 1 << 16):
        parser.feed(html[i : i + (1 << 16)])
    lines = parser.finish()
    if not lines:
        return ""
    lift_names(parser.blocks, lines)
    content = content_lines(lines)
    if max(x.prior for (x, _), c in zip(lines, content) if c) < LEAST_PRIOR:
        return ""  # nothing but furniture
    return "\n".join(region_lines(parser.blocks, lines, content))


def extract_main_text(pages: DataFrame, html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The main text of every page: ``keys``, ``text`` and ``n_chars`` (code points).

    One map over the rows, whole pages: no shuffle.  Defined cases: a null or empty page, or one
    without content or with nothing but furniture, has an empty text; markup that breaks off is read as far as it goes; an
    unknown character reference stays as it is; repeated rows give repeated results; other
    columns are ignored; an empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def extract(html: pd.Series) -> pd.Series:
        return html.map(main_text, na_action=None)

    text = extract(F.col(html_col))
    return pages.select(*keys, text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
