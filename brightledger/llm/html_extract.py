"""Main text of HTML pages by two-pass block rules.

A page is read as a stream of tags into blocks (the text between block-level tags, with its link characters
and the containers around it). Pass one decides what it can: blocks in menus, headers, footers, sidebars,
forms, notices, adverts and comments, and blocks made of links, are out; longer blocks are in where they have a running
text's share of stop words, or few links, whatever their language. Pass two gives each ambiguous block (short ones and
headings) the label of the nearest decided neighbour, in its own container before the page at large;
between two at the same distance a heading takes the one below it and any other block the one above.

Words of a class, id or role mark a container as a sidebar, comments and so on, but do not decide alone: a container is
not out when it holds the only articles of the page, when just a part of each of its names is such a word (``has-sidebar``)
and it holds most of the page's running text, or when all running text of the page would be out.

Defined cases: null and empty pages give an empty text; unclosed and crossed tags are closed as browsers do
for paragraphs and list items; a head ends at the first tag or text that cannot be in it; a hidden element (but
``script`` and ``style``) without an end tag of its own hides nothing; character references are decoded, also without their semicolon; a page of
which nothing can be decided keeps its ambiguous blocks; repeated page_ids each keep their row.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, slices

#: Common function words of English, French, German, Spanish, Italian, Portuguese, Dutch and Polish.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "one you were all her she there would their we him been has when who will no more if out so up said what its about "
    "le la les de des du un une et à en est que qui dans pour pas sur au aux ce cette il elle ne se par plus avec sont "
    "der die das den dem des und ist von zu mit sich auf für nicht ein eine als auch es an er aus bei im sie werden "
    "el los las y en del al que un una por con para es no se su lo como más o pero sus le ya este "
    "il lo gli di che è per non si con da sono nel della dei alla anche come più ma ed questo essere "
    "os as em do da dos das não uma com se na no por mais ao foi como mas são "
    "het een van en dat niet zijn op te aan met voor door er maar ook bij naar deze wordt "
    "w i z na do nie się jest to że od po przez jak ale oraz jego który są dla".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never shown, or is no text.
HIDDEN_TAGS = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button datalist".split())
#: What may be in a head; any other tag, and text, ends it.
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Their end tags may be left out, or they end with their parent.
OPTION_TAGS = frozenset("option optgroup".split())
OUTER_TAGS = frozenset("nav header footer aside form menu dialog".split())
BODY_TAGS = frozenset("article main".split())
SECTION_TAGS = BODY_TAGS | OUTER_TAGS | frozenset("section div body html td".split())
#: Words of a class, id or role that mark what is not the article.
OUTER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice popup modal overlay comment "
    "comments disqus replies share sharing social related recommended newsletter subscribe subscription login signup "
    "search widget complementary contentinfo pagination".split()
)
#: Elements that decide where blocks begin, what is hidden and what is a link; others pass by without a trace.
KEPT_TAGS = BLOCK_TAGS | SECTION_TAGS | HIDDEN_TAGS | OPTION_TAGS
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
SHORT = 70
LINKED, FEW_LINKS = 0.5, 0.2
RUNNING = 0.2

WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    container: int
    outer: bool
    body: bool
    heading: bool
    marks: tuple = ()
    text: str = ""
    linked: int = 0
    label: bool | None = None


@dataclass
class Open:
    tag: str
    outer: bool
    body: bool
    hidden: bool
    container: int
    marks: tuple = ()
    number: int = -1
    link: bool = False


@dataclass
class Mark:
    """A container that words of its class, id or role mark; ``whole`` where they make up one of its names."""

    whole: bool
    bodies: int = 0
    main: bool = False
    released: bool = False


@dataclass
class Blocks(HTMLParser):
    """Cuts a page into blocks."""

    found: list[Block] = field(default_factory=list)
    #: Numbers of hidden elements that have no end tag; they hide nothing.
    plain: frozenset = frozenset()

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Open("", False, False, False, 0)]
        #: How many elements of each name are open: what is not open need not be looked for.
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        self.containers = 0
        self.marks: list[Mark] = []
        self.bodies = 0
        self.hiding = 0
        self.unclosed: set[int] = set()

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                at = self.stack[-1]
                heading = any(re.fullmatch("h[1-6]", o.tag) for o in self.stack[-3:])
                self.found.append(Block(at.container, at.outer, at.body, heading, at.marks, text, self.linked))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._end_head(tag == "body")
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCK_TAGS:
            self.flush()
            while tag not in OPTION_TAGS and self.stack[-1].tag in OPTION_TAGS:
                self._pop(len(self.stack) - 1)
            for closed in (CLOSES.get(tag, set()), {"p"}):
                self._close_any(closed, SECTION_TAGS | {"ul", "ol", "table", "dl"} if tag != "p" else SECTION_TAGS)
        if tag in VOID_TAGS:
            return
        if tag == "a":
            self._end("a")
        at = self.stack[-1]
        number = -1
        if tag in HIDDEN_TAGS and tag != "head":
            number = self.hiding
            self.hiding += 1
        hidden = (tag in HIDDEN_TAGS and number not in self.plain) or tag in OPTION_TAGS or any(k == "hidden" for k, _ in attrs)
        marks = at.marks
        if tag in BODY_TAGS:
            self.bodies += 1
            for m in marks:
                self.marks[m].bodies += 1
                self.marks[m].main |= tag == "main"
        elif tag not in ("html", "body"):
            names = [set(re.findall("[a-z]+", name)) for k, v in attrs if k in ("class", "id", "role") for name in (v or "").lower().split()]
            if any(name & OUTER_WORDS for name in names):
                marks = (*marks, len(self.marks))
                self.marks.append(Mark(any(name and name <= OUTER_WORDS for name in names)))
        container = at.container
        if tag in SECTION_TAGS:
            self.containers += 1
            container = self.containers
        link = tag == "a" and any(k == "href" for k, _ in attrs)
        if not (link or hidden or tag in KEPT_TAGS or marks is not at.marks):
            return
        self.links += link
        self.open[tag] += 1
        self.stack.append(Open(tag, at.outer or tag in OUTER_TAGS, at.body or tag in BODY_TAGS, at.hidden or hidden, container, marks, number, link))

    def _close_any(self, tags: set[str], within: frozenset | set) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if self.stack[i].number >= 0 and self.stack[i].number not in self.plain:
                return
            if tag in tags:
                self._pop(i)
                return
            if tag in within:
                return

    def _end_head(self, anywhere: bool) -> None:
        """Closes an open head: where it is what is open, or at a body ``anywhere`` in it."""
        if not self.open["head"]:
            return
        for i in range(len(self.stack) - 1 if not anywhere else 1, len(self.stack)):
            if self.stack[i].tag == "head":
                self._pop(i)
                return

    def _pop(self, i: int, closed: bool = False) -> None:
        self.unclosed |= {o.number for o in self.stack[i + closed :] if o.number >= 0}
        self.links -= sum(o.link for o in self.stack[i:])
        self.open.subtract(o.tag for o in self.stack[i:])
        del self.stack[i:]

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        self._end(tag)

    def _end(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1) if self.open[tag] else ():
            if self.stack[i].tag == tag:
                self._pop(i, closed=True)
                return

    def end(self) -> None:
        self.close()
        self.flush()
        self._pop(1)

    def handle_data(self, data):
        if data.strip():
            self._end_head(False)
        if not self.stack[-1].hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def dense(b: Block) -> bool:
    """Whether stop words make up a running text's share of the block."""
    words = WORD.findall(b.text.lower())
    return sum(w in STOP_WORDS for w in words) >= RUNNING * max(1, len(words))


def long_text(b: Block) -> bool:
    return len(b.text) >= SHORT and not b.heading and b.linked <= FEW_LINKS * len(b.text)


def weigh_marks(page: Blocks) -> None:
    """Puts out the blocks of marked containers, but of those that are or hold the article."""
    if not page.marks:
        return
    texts = [b for b in page.found if not b.outer and long_text(b)]
    # Stop words tell the article from other text where the page's language is a known one.
    texts = [b for b in texts if dense(b)] or texts
    size = sum(len(b.text) for b in texts)
    inside = [0] * len(page.marks)
    for b in texts:
        for m in b.marks:
            inside[m] += len(b.text)
    for mark, n in zip(page.marks, inside):
        alone = mark.bodies == page.bodies
        mark.released = mark.main or alone and (mark.bodies > 0 or not mark.whole and 2 * n > size)
    if texts and not any(all(page.marks[m].released for m in b.marks) for b in texts):
        for mark, n in zip(page.marks, inside):
            mark.released |= 2 * n > size
    for b in page.found:
        b.outer |= not all(page.marks[m].released for m in b.marks)


def first_pass(b: Block) -> bool | None:
    """In, out, or not decided yet."""
    if b.outer or b.linked > LINKED * len(b.text):
        return False
    if len(b.text) < SHORT or b.heading:
        return None
    return b.linked <= FEW_LINKS * len(b.text) or dense(b)


def second_pass(blocks: list[Block]) -> None:
    """Undecided blocks take the label of the nearest decided one, in their own container first."""

    def neighbours(own: list[int]) -> dict[int, tuple]:
        above, below, last = {}, {}, None
        for i in own:
            above[i] = last
            last = i if blocks[i].label is not None else last
        last = None
        for i in reversed(own):
            below[i] = last
            last = i if blocks[i].label is not None else last
        return {i: (above[i], below[i]) for i in own}

    within: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        within.setdefault(b.container, []).append(i)
    near: dict[int, tuple] = {}
    for own in within.values():
        near |= neighbours(own)
    page = neighbours(list(range(len(blocks))))
    labels = {}
    for i, b in enumerate(blocks):
        if b.label is not None:
            continue
        above, below = near[i] if near[i] != (None, None) else (None, None) if b.body else page[i]
        if above is None and below is None:
            labels[i] = True
        elif above is None or below is None:
            labels[i] = blocks[below if above is None else above].label
        else:
            up, down = i - above, below - i
            labels[i] = blocks[below if down < up or down == up and b.heading else above].label
    for i, label in labels.items():
        blocks[i].label = label


def main_text(html: str | None) -> str:
    parser = Blocks()
    parser.feed(html or "")
    parser.end()
    if parser.unclosed:
        parser = Blocks(plain=frozenset(parser.unclosed))
        parser.feed(html or "")
        parser.end()
    weigh_marks(parser)
    for b in parser.found:
        b.label = first_pass(b)
    second_pass(parser.found)
    return " ".join(b.text for b in parser.found if b.label)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)``, a row for every input row; no shuffle."""

    def run(batches):
        for batch in slices(batches):
            out = pa.array([main_text(h.as_py()) for h in batch.column(2)], pa.string())
            yield pa.record_batch([batch.column(0), batch.column(1), out], ["page_id", "url", "text"])

    kept = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return kept.mapInArrow(run, "page_id long, url string, text string")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_pages(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
