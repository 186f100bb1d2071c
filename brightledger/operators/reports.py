"""Reports as HTML: decoding, cleaning, blocks, sections, and checks of what was read.

A page is tokenised once, in a map over partitions; everything after that is DataFrame code on its blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.functions.text import any_of, sliced

ENCODINGS = ("euc-kr", "utf-8", "cp949")
#: ``part`` is head or foot of a table for cells that stand there, body for others.
BLOCKS = "page_id long, pos int, tag string, class string, text string, table_index int, row_index int, col_index int, part string"
ENDS = frozenset("p div h1 h2 h3 h4 h5 h6 li td th tr table ul ol article section nav header footer body title caption".split())
HIDDEN = frozenset("script style".split())
PARTS = {"thead": "head", "tbody": "body", "tfoot": "foot"}
#: Plain tags: names of letters and digits, attributes with quoted values and without references.
_SPACE = "[ \\t\\n\\r\\f]"
_ATTRIBUTE = rf"""{_SPACE}+[a-zA-Z][a-zA-Z0-9_:-]*=(?:"[^"<>&]*"|'[^'<>&]*')"""
TAG = re.compile(rf"<(?:/([a-zA-Z][a-zA-Z0-9]*){_SPACE}*|([a-zA-Z][a-zA-Z0-9]*)((?:{_ATTRIBUTE})*){_SPACE}*(/?))>")
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_:-]*)=(?:"([^"]*)"|'([^']*)')""")
#: What pages of plain tags do not have: comments, declarations, instructions, and texts that are no text.
ODD = ("<!", "<?", "<script", "<style")
#: Tags that are more than markup inside of a block.
TOLD = ENDS | PARTS.keys() | {"br"}
#: Blocks in one batch of what is read, and characters of tags whose shapes a worker remembers.
BATCH, SHAPES = 20_000, 1_000_000


def decoded(content: str, encodings: Sequence[str] = ENCODINGS) -> Column:
    """Bytes as text by the first encoding that fits; null if none does."""

    def one(data):
        for name in encodings:
            try:
                return bytes(data).decode(name)
            except (UnicodeDecodeError, TypeError):
                continue
        return None

    take = sliced(one, pa.string())

    @F.arrow_udf("string")
    def decode(parts: pa.Array) -> pa.Array:
        return take(parts)

    return decode(F.col(content))


def cleaned(html: str) -> Column:
    """Broken headings mended, scripts, styles, spans and empty layout tags gone, runs of line breaks single."""
    c = F.col(html)
    steps = (
        (r"(?is)<h3([^>]*)>((?:(?!</h3>).)*?)<p>((?:(?!</h3>).)*?)</h3>\s*</p>", "<h3$1>$2$3</h3>"),
        (r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", ""),
        (r"(?i)<(?:meta|link)\b[^>]*>", ""),
        (r"(?i)</?span\b[^>]*>", ""),
        (r"(?i)<(p|div)\b[^>]*>(?:\s|&nbsp;|<br\s*/?>)*</\1>", ""),
        (r"(?i)(?:<br\s*/?>\s*){2,}", "<br>"),
    )
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


class _Reader(HTMLParser):
    """Text of block tags in page order, with the place of the table cell that it is in, however deep."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.parts, self.skip, self.count = [], [], 0, 0
        #: Open tags: name, class, place of the cell that they are in.
        self.open = [("", "", None)]
        #: Open tables: number, row, column, the columns that cells from above still fill, by row, and the part.
        self.tables = []

    def read(self, html: str) -> list[tuple]:
        """The rows of a page. A page of plain tags is cut at them at once; any other one is parsed by the rules of HTML."""
        low = html.lower()
        cut = [] if any(o in low for o in ODD) else TAG.split(html)
        if not cut or any("<" in text for text in cut[::5]):
            self.feed(html)
            self.close()
        else:
            self._cut(cut)
        self.flush()
        return self.rows

    def _cut(self, cut: list[str]):
        """Goes through a page that is cut into texts and their tags: what ends, or begins, with its attributes and whether it is closed at once."""
        parts = self.parts
        parts.append(unescape(cut[0]))
        for ended, begun, attrs, closed, text in zip(cut[1::5], cut[2::5], cut[3::5], cut[4::5], cut[5::5]):
            if ended:
                if ended in ENDS or (ended := ended.lower()) in ENDS:
                    self.handle_endtag(ended)
                    parts = self.parts
            elif begun in TOLD or (begun := begun.lower()) in TOLD:
                self.handle_starttag(begun, [(k.lower(), a or b) for k, a, b in ATTRIBUTE.findall(attrs)] if attrs else ())
                if closed:
                    self.handle_endtag(begun)
                parts = self.parts
            if text:
                parts.append(unescape(text) if "&" in text else text)

    def flush(self):
        text = " ".join((self.parts[0] if len(self.parts) == 1 else "".join(self.parts)).split())
        if text:
            tag, cls, place = self.open[-1]
            self.rows.append((len(self.rows), tag, cls, text, *(place or (None,) * 4)))
        self.parts = []

    def _close(self, names, stop=()):
        """Closes the innermost open tag of a name, and what is in it; not beyond a tag of ``stop``."""
        if len(self.open) > 1 and self.open[-1][0] in names:
            if self.open.pop()[0] == "table":
                self.tables.pop()
            return
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name in names:
                if inner := sum(o[0] == "table" for o in self.open[i:]):
                    del self.tables[-inner:]
                del self.open[i:]
                return
            if name in stop:
                return

    def _next_cell(self, tag, attrs):
        table = self.tables[-1]
        taken = table[3].setdefault(table[1], set())
        col = table[2] + 1
        while col in taken:
            col += 1
        wide, high = (int(v) if (v := attrs.get(k) or "").isdigit() and 0 < int(v) <= 1000 else 1 for k in ("colspan", "rowspan"))
        for below in range(1, high):
            table[3].setdefault(table[1] + below, set()).update(range(col, col + wide))
        table[2] = col + wide - 1
        return table[0], table[1], col, "head" if tag == "th" else table[4]

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        self.skip += tag in HIDDEN
        if tag in ENDS:
            if self.parts:
                self.flush()
            place = self.open[-1][2]
            if tag == "table":
                self.tables.append([self.count, -1, -1, {}, "body"])
                self.count, place = self.count + 1, None
            elif tag == "tr" and self.tables:
                self._close({"tr"}, {"table"})
                self.tables[-1][1:3] = self.tables[-1][1] + 1, -1
                place = None
            elif tag in ("td", "th") and self.tables:
                self._close({"td", "th"}, {"table", "tr"})
                place = self._next_cell(tag, attrs)
            self.open.append((tag, attrs.get("class") or "", place))
        elif tag in PARTS and self.tables:
            self.tables[-1][4] = PARTS[tag]
        elif tag == "br":
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.skip -= tag in HIDDEN and self.skip > 0
        if tag in ENDS:
            if self.parts:
                self.flush()
            self._close((tag,))

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


class Frame:
    """What pages have that are alike but for their texts: the tag, class and place of each block, by columns; and what others work out of these."""

    def __init__(self, found: Sequence[tuple]):
        self.n, self.columns, self.plans = len(found), [list(c) for c in zip(*found)] or [[] for _ in range(6)], {}


class Shapes:
    """Reads pages as ``_Reader`` does. Plain tags alone decide which texts are a block and where it is, so for tags that come again this is worked out once."""

    def __init__(self):
        #: By the tags of a page: false if they came once, null if they are not plain, or the number of texts, the page without them, what each block is made of, and frames.
        self.known, self.size = {}, 0

    def read(self, html: str) -> tuple[Frame, list[str]]:
        """The frame of a page and the texts of its blocks."""
        pieces = html.replace(">", "<").split("<")
        tags, texts = "<".join(pieces[1::2]), tuple(pieces[::2])
        shape = self.known.get(tags)
        if shape is None and tags not in self.known:
            self._note(tags, False)
        elif shape is False:
            shape = self.known[tags] = self._shape(pieces[1::2])
        # Brackets that are no tag's are for the parser.
        if not shape or len(texts) != shape[0] or shape[1] % texts != html:
            rows = _Reader().read(html)
            return Frame([r[1:3] + r[4:] for r in rows]), [r[3] for r in rows]
        _, _, made, found, frames = shape
        if "&" in html:
            texts = [unescape(t) if "&" in t else t for t in texts]
        if made:
            texts = [" ".join(["".join([texts[i] for i in line]) for line in lines]) for lines in made]
        texts = [t if not t or t.isalnum() else " ".join(t.split()) for t in texts]
        there = tuple(map(bool, texts))
        frame = frames.get(there)
        if frame is None:
            frame = Frame([f for f, t in zip(found, there) if t])
            self._note(tags, shape)
            frames[there] = frame
        return frame, [t for t in texts if t]

    def _note(self, tags: str, shape):
        self.size += len(tags)
        if self.size > SHAPES:
            self.known, self.size = {}, len(tags)
            if shape:
                shape[-1].clear()
        if self.size <= SHAPES:
            self.known[tags] = shape

    def _shape(self, tags: Sequence[str]) -> tuple | None:
        """Reads the tags with the numbers of the texts in their places."""
        whole = [f"<{t}>" for t in tags]
        low = "".join(whole).lower()
        if any(o in low for o in ODD) or not all(TAG.fullmatch(t) for t in whole):
            return None
        rows = _Reader().read("".join(f"{t}{i};" for i, t in enumerate(["", *whole])))
        made = [[[int(i) for i in line.split(";")[:-1]] for line in r[3].split()] for r in rows]
        single = made == [[[i]] for i in range(len(whole) + 1)]
        return len(whole) + 1, "%s".join(["", *[t.replace("%", "%%") for t in whole], ""]), None if single else made, [r[1:3] + r[4:] for r in rows], {}


def blocks(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """A row per block of text: its tag, class, place, and its table, row and column where it is a cell."""

    names = ("page_id", "pos", "text", "tag", "class", "table_index", "row_index", "col_index", "part")
    types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    order = [names.index(c.split()[0]) for c in BLOCKS.split(", ")]

    def made(columns: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(columns[i], types[i]) for i in order], [names[i] for i in order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            columns = [[] for _ in names]
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                frame, texts = shapes.read(html.as_py() or "")
                for column, values in zip(columns, ([key] * frame.n, range(frame.n), texts, *frame.columns)):
                    column += values
                # What a worker holds does not grow with the pages of a batch.
                if len(columns[0]) >= BATCH:
                    yield made(columns)
                    columns = [[] for _ in names]
            if columns[0]:
                yield made(columns)

    return pages.select(F.col(page).cast("long").alias("page_id"), F.col(html).alias("html")).mapInArrow(run, BLOCKS)


def sections(blocks_: DataFrame, heading: Column, name: str = "section_index") -> DataFrame:
    """Numbers each block by the headings before it on its page, 0 before the first."""
    w = W.partitionBy("page_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return blocks_.withColumn(name, F.sum(heading.cast("int")).over(w).cast("int"))


def section_contents(numbered: DataFrame, heading: Column) -> DataFrame:
    """Per section: its title and the text below it, in order, tables left out."""
    body = F.when(~heading & F.col("table_index").isNull(), F.struct("pos", "text"))
    parts = F.array_sort(F.collect_list(body))
    out = numbered.groupBy("page_id", "section_index").agg(F.max(F.when(heading, F.col("text"))).alias("title"), parts.alias("__p"), F.count(F.lit(1)).alias("n_blocks"))
    return out.select("page_id", "section_index", "title", F.array_join(F.transform("__p", lambda p: p["text"]), "\n").alias("content"), "n_blocks")


def section_issues(sections_: DataFrame, least: int = 50) -> DataFrame:
    """``(page_id, section_index, issue)``: sections without title, without content, or with little."""
    issues = F.array_compact(
        F.array(F.when(F.col("title").isNull(), "no_title"), F.when(F.trim("content") == "", "no_content"), F.when((F.length("content") < least) & (F.trim("content") != ""), "short_content"))
    )
    return sections_.select("page_id", "section_index", F.explode(issues).alias("issue"))


def required_sections(sections_: DataFrame, key: Sequence[str], title: str, required: dict[str, Sequence[str]], n_parts: Column) -> DataFrame:
    """Per report: the required sections whose words no title has, and the score: those found, and one point for any subsection, of all points."""
    found = {name: F.bool_or(F.coalesce(any_of(F.col(title), words), F.lit(False))) for name, words in required.items()}
    missing = F.array_compact(F.array(*[F.when(~f, name) for name, f in found.items()]))
    parts = F.coalesce(F.sum(n_parts), F.lit(0))
    out = sections_.groupBy(*key).agg(F.count(F.lit(1)).alias("total_sections"), missing.alias("missing"), parts.alias("total_subsections"))
    points = F.lit(len(required)) - F.size("missing") + F.when(F.col("total_subsections") > 0, 1).otherwise(0)
    return out.withColumn("score", points / (len(required) + 1))


def quality_score(sections_: DataFrame, issues: DataFrame, required: int, tables: DataFrame | None = None) -> DataFrame:
    """Per page: 0.6 for the sections found against those required, 0.3 for the share of valid tables, 0.1 less a little for each issue.

    A page without tables has all of their share.
    """
    found = sections_.groupBy("page_id").agg(F.count_if(F.col("title").isNotNull()).alias("found"))
    both = found.join(issues.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_issues")), "page_id", "left")
    if tables is None:
        both = both.withColumns({"n_tables": F.lit(0).cast("long"), "n_valid": F.lit(0).cast("long")})
    else:
        valid = tables.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_tables"), F.count_if(F.col("status") == "valid").alias("n_valid"))
        both = both.join(valid, "page_id", "left")
    both = both.na.fill(0, ["n_issues", "n_tables", "n_valid"])
    share = F.when(F.col("n_tables") > 0, F.col("n_valid") / F.col("n_tables")).otherwise(1.0)
    clean = F.greatest(F.lit(0.0), 1 - 0.05 * F.col("n_issues"))
    score = 0.6 * F.least(F.col("found") / required, F.lit(1.0)) + 0.3 * share + 0.1 * clean
    return both.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def subsections(numbered: DataFrame, numbered_heading: Column, section: str = "section_index") -> DataFrame:
    """Numbers the numbered headings within each section, 0 before the first."""
    w = W.partitionBy("page_id", section).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return numbered.withColumn("subsection_index", F.sum(numbered_heading.cast("int")).over(w).cast("int"))


def structure_issues(reports_: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """``(key, issue)``: required fields that are missing from the schema or null in a row."""
    missing = [F.lit(f"no_{c}") for c in required if c not in reports_.columns]
    null = [F.when(F.col(c).isNull(), f"null_{c}") for c in required if c in reports_.columns]
    return reports_.select(key, F.explode(F.array_compact(F.array(*missing, *null))).alias("issue"))


def report_validation(sections_: DataFrame, tables: DataFrame, required: int) -> DataFrame:
    """Per page: sections found, valid tables, issues, and the quality score."""
    return quality_score(sections_, section_issues(sections_), required, tables)


def table_parts(blocks_: DataFrame, key: Sequence[str] = ("page_id", "table_index")) -> DataFrame:
    """Whether each table has a head (a ``thead``, or cells that are headings) and a foot, and how many cells are in either."""
    cells = blocks_.where(F.col("table_index").isNotNull()).select(*key, "row_index", "col_index", "part").distinct()
    head, foot = F.count_if(F.col("part") == "head"), F.count_if(F.col("part") == "foot")
    return cells.groupBy(*key).agg((head > 0).alias("has_header"), (foot > 0).alias("has_footer"), head.alias("head_cells"), foot.alias("foot_cells"))


def table_status(cells: DataFrame, key: Sequence[str] = ("page_id", "table_index")) -> DataFrame:
    """``status`` of each table of cells: empty, mostly empty, or valid."""
    blank = F.count_if(F.trim("text") == "") / F.count(F.lit(1))
    status = F.when(F.max(F.trim("text")) == "", "empty").when(blank > 0.5, "mostly_empty").otherwise("valid")
    return cells.groupBy(*key).agg(status.alias("status"))


def texts_status(texts: Column) -> Column:
    """The status that ``table_status`` gives to a table whose texts are one array."""
    blank, told = (F.size(F.filter(texts, f)) for f in (lambda t: F.trim(t) == "", lambda t: F.trim(t) != ""))
    return F.when((told == 0) & (blank > 0), "empty").when(F.try_divide(blank, F.size(texts)) > 0.5, "mostly_empty").otherwise("valid")
