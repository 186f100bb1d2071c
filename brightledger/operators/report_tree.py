"""Reports as trees: main sections, their numbered parts, the notes, and what a report's record says of all of them.

Blocks of a page, in order, are folded into sections by a grammar of headings. A heading is a block whose class names a section.
What it is depends on its tag and text and on the main section that it stands in, so the state that is carried along a page is
the last main section and the numbers given so far. A page is read by one task, as it is one document, so ``page_sections`` and
``records`` carry that state along while they read and shuffle nothing; of blocks that are there already, ``section_tree`` makes
the same by windows, all dealt by the page.

* ``h2`` of class ``SECTION-1``: a main section, ``SECTION-1-i``;
* in a main section, a heading whose text begins with a number: a part of it, ``SECTION-1-i-j``;
* in the section on the external audit only ``p`` of class ``SECTION-2`` count, all of them for ``j``, numbered ones as parts;
* a heading that names the notes without a number, in another main section, or the first ``h3`` of class ``SECTION-2`` that
  names them anywhere: the notes, a section of level 1 of their own, which count for ``j`` where they stand in a main section;
* any other heading begins nothing, but ends what is before it.

Defined cases: a page without main sections has at most its notes; parts before the first main section are none; empty pages
have no rows here and a record of nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.functions.text import any_of
from brightledger.operators.reports import BATCH, Frame, Shapes

# --- fixed values: classes and words of headings, and what validation looks for
ANY, MAIN, PART = "SECTION", "SECTION-1", "SECTION-2"
NOTES_ID, NOTES, AUDIT = "SECTION-2-INDEPENDENT", "주석", "외부감사 실시내용"
NUMBER = r"^\d+\.\s*"
NUMBERED, GREATEST = re.compile(r"([0-9]+)\."), 2**31 - 1
#: Kinds of headings that are remembered of one frame of blocks.
PLANS = 20
REQUIRED_TITLES = {"재무제표": ("재무제표", "(첨부)재무제표", "재 무 제 표"), "주석": ("주석", "주석사항"), "감사의견": ("감사의견", "독립된 감사인의 감사보고서", "감사보고서")}
REQUIRED_TYPES = ("SECTION-1", "SECTION-2")
FINANCIAL_KEYWORDS = ("매출액", "매출원가", "영업이익", "당기순이익", "자산", "부채", "자본", "현금", "투자")

#: A section's fields, after its page.
SECTION = {
    "pos": "int", "section_id": "string", "section_type": "string", "title": "string", "hierarchy_level": "int", "parent_id": "string", "parent_title": "string", "section_number": "int",
    "content": "string", "n_tables": "int", "segment": "long",
}
SECTION_SCHEMA = ", ".join(f"{name}: {kind}" for name, kind in SECTION.items())
TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind] for kind in SECTION.values()]


def headings(blocks_: DataFrame) -> DataFrame:
    """The blocks with ``segment`` (headings before it on its page, itself included) and, where one is a heading, what it begins.

    ``kind`` is main, part, notes or null; ``main_index``, ``part_index`` and ``main_title`` are of the main section around.
    """
    page = W.partitionBy("page_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    css, text = F.coalesce("class", F.lit("")), F.col("text")
    mark = css.contains(ANY)
    main = (F.col("tag") == "h2") & css.contains(MAIN)
    named, numbered = F.lower(text).contains(NOTES), text.rlike(NUMBER)
    alone = (F.col("tag") == "h3") & css.contains(PART) & named
    seen = blocks_.withColumns({
        "segment": F.sum(mark.cast("int")).over(page), "main_index": F.sum(main.cast("int")).over(page),
        "main_title": F.last(F.when(main, text), ignorenulls=True).over(page), "__alone": F.sum(alone.cast("int")).over(page),
    })
    inside = mark & ~main & (F.col("main_index") > 0)
    audit = F.coalesce(F.col("main_title").contains(AUDIT), F.lit(False))
    small = (F.col("tag") == "p") & css.contains(PART)
    counted = inside & F.when(audit, small).otherwise(numbered | named)
    part = inside & numbered & F.when(audit, small).otherwise(F.lit(True))
    first = alone & (F.col("__alone") == 1)
    notes = (inside & ~audit & named & ~numbered) | first
    kind = F.when(main, "main").when(notes, "notes").when(part, "part")
    # Counted along the page, less what was counted where the main section began: the same order of rows serves all windows.
    seen = seen.withColumns({"__counted": F.sum(counted.cast("int")).over(page), "is_heading": mark, "kind": kind})
    before = F.coalesce(F.last(F.when(main, F.col("__counted")), ignorenulls=True).over(page), F.lit(0))
    return seen.withColumn("part_index", F.col("__counted") - before).drop("__alone", "__counted")


def section_tree(blocks_: DataFrame) -> DataFrame:
    """A row per section, part and notes of each page, in the order of ``pos``.

    ``page_id, pos, section_id, section_type, title, hierarchy_level, parent_id, parent_title, section_number, content, n_tables, segment``:
    ``content`` is the text of the blocks up to the next heading, tables left out, a line for each; ``n_tables`` are the tables there.
    """
    heading = F.col("is_heading")
    body = F.when(~heading & F.col("table_index").isNull(), F.struct("pos", "text"))
    lines = F.transform(F.array_sort(F.collect_list(body)), lambda b: b["text"])
    top = F.first(F.when(heading, F.struct("pos", "kind", "text", "main_index", "part_index", "main_title")), ignorenulls=True)
    out = headings(blocks_).groupBy("page_id", "segment").agg(top.alias("h"), F.array_join(lines, "\n").alias("content"), F.size(F.collect_set("table_index")).alias("n_tables"))
    kind, in_main = F.col("h.kind"), F.concat(F.lit(f"{MAIN}-"), F.col("h.main_index").cast("string"))
    part = F.concat(in_main, F.lit("-"), F.col("h.part_index").cast("string"))
    return out.where(kind.isNotNull()).select(
        "page_id", "h.pos", F.when(kind == "main", in_main).when(kind == "part", part).otherwise(NOTES_ID).alias("section_id"),
        F.when(kind == "main", MAIN).otherwise(PART).alias("section_type"), F.col("h.text").alias("title"),
        F.when(kind == "part", 2).otherwise(1).alias("hierarchy_level"), F.when(kind == "part", in_main).alias("parent_id"),
        F.when(kind == "part", F.col("h.main_title")).alias("parent_title"),
        F.when(kind == "part", F.regexp_extract("h.text", r"^(\d+)\.", 1).try_cast("int")).alias("section_number"), "content", "n_tables", "segment",
    )


def _number(text: str) -> int | None:
    digits = NUMBERED.match(text)[1].lstrip("0") or "0"
    return int(digits) if len(digits) <= 10 and int(digits) <= GREATEST else None


def _told(rows: list[tuple]) -> list[tuple]:
    """The sections of one page's blocks, in order, by the rules of ``headings``: the fields of ``section_tree`` after the page."""
    out, lines, tables = [], None, None
    segment = mains = counted = 0
    title, audit, alone = None, False, False
    for pos, tag, css, text, table, _, _, _ in rows:
        if ANY not in css:
            if lines is not None:
                if table is None:
                    lines.append(text)
                else:
                    tables.add(table)
            continue
        segment += 1
        lines, tables = [], set() if table is None else {table}
        if tag == "h2" and MAIN in css:
            mains, counted, title, audit = mains + 1, 0, text, AUDIT in text
            out.append((pos, f"{MAIN}-{mains}", MAIN, text, 1, None, None, None, lines, tables, segment))
            continue
        number, named, small = NUMBERED.match(text), NOTES in text, tag == "p" and PART in css
        first = named and not alone and tag == "h3" and PART in css
        alone = alone or first
        inside = mains > 0 and (small if audit else bool(number or named))
        counted += inside
        if first or inside and not audit and named and not number:
            out.append((pos, NOTES_ID, PART, text, 1, None, None, None, lines, tables, segment))
        elif inside and number:
            out.append((pos, f"{MAIN}-{mains}-{counted}", PART, text, 2, f"{MAIN}-{mains}", title, _number(text), lines, tables, segment))
        else:
            lines = None
    return [(*s[:8], "\n".join(s[8]), len(s[9]), s[10]) for s in out]


class _Sections:
    """Sections of pages with one frame and headings of one kind: fields that are the same, and which blocks make the others."""

    def __init__(self, told: list[tuple]):
        columns = [list(c) for c in zip(*told)] or [[] for _ in SECTION]
        at = [None if t is None else int(t.rpartition("#")[2]) for t in columns[3]]
        self.n, self.same = len(told), [(i, columns[i]) for i in (0, 1, 2, 4, 5, 9, 10)]
        self.titles, self.above = at, [None if t is None else int(t.rpartition("#")[2]) for t in columns[6]]
        self.numbered, self.contents = [i if n is not None else None for i, n in zip(at, columns[7])], [[int(i) for i in c.split()] for c in columns[8]]

    def add(self, columns: list[list], texts: list[str]):
        for i, values in self.same:
            columns[i] += values
        columns[3] += [texts[i] for i in self.titles]
        columns[6] += [None if i is None else texts[i] for i in self.above]
        columns[7] += [None if i is None else _number(texts[i]) for i in self.numbered]
        columns[8] += ["\n".join([texts[i] for i in c]) for c in self.contents]


class _Plan:
    """What is made of pages with one frame and headings of one kind: their sections; those of level 1, their parts, and where each one's parts end; tables; the title."""

    def __init__(self, frame: Frame, kinds: dict[int, tuple]):
        # The rules see texts that say which block they are, and of headings what matters.
        said = [f"{'1.' * kinds[i][0]}{NOTES * kinds[i][1]}{AUDIT * kinds[i][2]}#{i}" if i in kinds else str(i) for i in range(frame.n)]
        tags, classes, tables, *_ = frame.columns
        told = _told([(i, tags[i], classes[i], said[i], tables[i], None, None, None) for i in range(frame.n)])
        tops = [s for s in told if s[4] == 1]
        low = [[s for s in told if s[4] == 2 and s[5] == t[1]] for t in tops]
        self.every, self.tops, self.parts = _Sections(told), _Sections(tops), _Sections([s for own in low for s in own])
        self.ends = list(accumulate(map(len, low)))
        self.title = tags.index("title") if "title" in tags else None
        self.tables = [[i for i in range(frame.n) if tables[i] == t] for t in dict.fromkeys(tables) if t is not None]


def _plan(frame: Frame, texts: list[str]) -> _Plan:
    marks = frame.plans.get("marks")
    if marks is None:
        marks = frame.plans["marks"] = [i for i, css in enumerate(frame.columns[1]) if ANY in css]
    kinds = tuple([(NUMBERED.match(t) is not None, NOTES in t, AUDIT in t) for t in [texts[i] for i in marks]])
    plan = frame.plans.get(kinds)
    if plan is None:
        if len(frame.plans) > PLANS:
            frame.plans = {"marks": marks}
        plan = frame.plans[kinds] = _Plan(frame, dict(zip(marks, kinds)))
    return plan


def _arrays(columns: list[list], types: Sequence[pa.DataType] = ()) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(columns, types or TYPES)]


def _lists(ends: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), values)


def page_sections(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """The rows of ``section_tree``, made where a page is read: no block leaves its task."""

    def made(keys: list, columns: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(keys, pa.int64()), *_arrays(columns)], ["page_id", *SECTION])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            keys, columns, n = [], [[] for _ in SECTION], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                frame, texts = shapes.read(text.as_py() or "")
                sections = _plan(frame, texts).every
                sections.add(columns, texts)
                keys += [key] * sections.n
                n += frame.n
                # What a worker holds does not grow with the pages of a batch.
                if n >= BATCH:
                    yield made(keys, columns)
                    keys, columns, n = [], [[] for _ in SECTION], 0
            if keys:
                yield made(keys, columns)

    return pages.select(F.col(page).cast("long").alias("page_id"), F.col(html).alias("html")).mapInArrow(run, f"page_id long, {SECTION_SCHEMA}")


def section_cells(blocks_: DataFrame, tree: DataFrame) -> DataFrame:
    """Cells of the tables in sections: ``page_id, section_id, title, section_pos, table, table_index, row_index, col_index, text``.

    ``table`` is the number of the table in its section, from 0; ``table_index`` that on the page.
    """
    cells = headings(blocks_).where(F.col("table_index").isNotNull() & ~F.col("is_heading"))
    # Cells of several blocks are one text, in order.
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda b: b["text"]), " ")
    whole = cells.groupBy("page_id", "segment", "table_index", "row_index", "col_index").agg(text.alias("text"))
    numbered = whole.withColumn("table", F.dense_rank().over(W.partitionBy("page_id", "segment").orderBy("table_index")) - 1)
    named = tree.select("page_id", "segment", "section_id", "title", F.col("pos").alias("section_pos"))
    return numbered.join(named, ["page_id", "segment"]).drop("segment")


def all_text(blocks_: DataFrame) -> DataFrame:
    """``(page_id, all_text)``: the text of all blocks of a page, a line for each."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda b: b["text"])
    return blocks_.groupBy("page_id").agg(F.array_join(lines, "\n").alias("all_text"), F.count(F.lit(1)).cast("int").alias("total_elements_parsed"))


def records(pages: DataFrame, key: str = "page_id", name: str = "source_file", html: str = "html", title: str = "감사보고서", tables: bool = False) -> DataFrame:
    """The records of ``reports``, made where a page is read; with ``tables``, also the texts of each table's blocks."""
    named = {"page_id": pa.int64(), "source_file": pa.string(), "bytes": pa.int64(), "found": pa.string(), "all_text": pa.string(), "elements": pa.int32(), "tables": pa.list_(pa.list_(pa.string()))}
    named = {name: of for name, of in named.items() if tables or name != "tables"}

    def made(rows: list[tuple], tops: list[list], parts: list[list], ends: list[int]) -> pa.RecordBatch:
        *columns, of_page = zip(*rows)
        low = _lists(ends, pa.StructArray.from_arrays(_arrays(parts), list(SECTION)))
        sections = _lists(of_page, pa.StructArray.from_arrays([*_arrays(tops), low], [*SECTION, "subsections"]))
        return pa.record_batch([*_arrays(columns, list(named.values())), sections], [*named, "sections"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            rows, tops, parts, ends, n = [], [[] for _ in SECTION], [[] for _ in SECTION], [], 0
            for first, text in zip(zip(*(batch.column(i).to_pylist() for i in range(3))), batch.column(3)):
                frame, texts = shapes.read(text.as_py() or "")
                plan = _plan(frame, texts)
                before = len(parts[0])
                ends += [before + e for e in plan.ends]
                plan.tops.add(tops, texts)
                plan.parts.add(parts, texts)
                more = ([[texts[i] for i in t] for t in plan.tables],) if tables else ()
                rows.append((*first, None if plan.title is None else texts[plan.title], "\n".join(texts), frame.n, *more, len(tops[0])))
                n += frame.n + 1
                # What a worker holds does not grow with the pages of a batch.
                if n >= BATCH:
                    yield made(rows, tops, parts, ends)
                    rows, tops, parts, ends, n = [], [[] for _ in SECTION], [[] for _ in SECTION], [], 0
            if rows:
                yield made(rows, tops, parts, ends)

    schema = "page_id long, source_file string, bytes long, found string, all_text string, elements int" + (", tables array<array<string>>" if tables else "")
    told = pages.select(F.col(key).cast("long").alias("page_id"), F.col(name).alias("source_file"), F.octet_length(F.coalesce(html, F.lit(""))).cast("long").alias("bytes"), F.col(html).alias("html"))
    read = told.mapInArrow(run, f"{schema}, sections array<struct<{SECTION_SCHEMA}, subsections: array<struct<{SECTION_SCHEMA}>>>>")
    n_parts = F.aggregate("sections", F.lit(0), lambda n, s: n + F.size(s["subsections"]))
    metadata = _metadata(F.size("sections"), n_parts, F.col("bytes"), F.col("elements"))
    return read.select("page_id", F.coalesce("found", F.lit(title)).alias("title"), metadata, "sections", "all_text", *(["tables"] if tables else []))


def reports(pages: DataFrame, tree: DataFrame, blocks_: DataFrame, key: str = "page_id", name: str = "source_file", html: str = "html", title: str = "감사보고서") -> DataFrame:
    """A record per page: ``page_id, title, metadata, sections, all_text``, sections holding their parts; of a tree that is there already.

    ``metadata`` counts main sections (the notes are one), parts, blocks and characters; the year is the first of the file's name.
    """
    fields = [c for c in tree.columns if c != "page_id"]
    low = F.col("hierarchy_level") == 2

    def listed(kept: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(kept, F.struct(*fields))))

    top = tree.groupBy("page_id").agg(listed(~low).alias("tops"), listed(low).alias("parts"))
    first = blocks_.where("tag = 'title'").groupBy("page_id").agg(F.min_by("text", "pos").alias("found"))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(name).alias("source_file"), F.octet_length(F.coalesce(html, F.lit(""))).alias("bytes"))
    joined = rows.join(all_text(blocks_), "page_id", "left").join(top, "page_id", "left").join(first, "page_id", "left")
    none = F.array().cast(tree.select(F.array(F.struct(*fields))).schema[0].dataType)
    joined = joined.withColumns({"tops": F.coalesce("tops", none), "parts": F.coalesce("parts", none), "all_text": F.coalesce("all_text", F.lit(""))})

    def with_parts(s: Column) -> Column:
        own = F.filter("parts", lambda p: p["parent_id"] == s["section_id"])
        return F.struct(*[s[f].alias(f) for f in fields], own.alias("subsections"))

    metadata = _metadata(F.size("tops"), F.size("parts"), F.col("bytes"), F.coalesce("total_elements_parsed", F.lit(0)))
    return joined.select("page_id", F.coalesce("found", F.lit(title)).alias("title"), metadata, F.transform("tops", with_parts).alias("sections"), "all_text")


def _metadata(tops: Column, parts: Column, size: Column, elements: Column) -> Column:
    return F.struct(
        F.lit("3.0").alias("version"), "source_file", F.regexp_extract("source_file", r"(\d{4})", 1).try_cast("int").alias("report_year"),
        tops.alias("total_sections"), parts.alias("total_subsections"), size.cast("long").alias("file_size_bytes"),
        elements.alias("total_elements_parsed"), F.length("all_text").alias("total_content_length"),
    ).alias("metadata")


# --- validation


def section_field_issues(s: Column) -> Column:
    """``array<string>``: what a section's record lacks: a field, a right type or level, a title of two characters."""
    kind, level, title = s["section_type"], s["hierarchy_level"], F.coalesce(s["title"], F.lit(""))
    return F.array_compact(F.array(
        *[F.when(s[f].isNull(), f"no_{f}") for f in ("section_id", "section_type", "title", "hierarchy_level")],
        F.when((kind != "") & ~kind.startswith("SECTION-"), "bad_section_type"), F.when(F.coalesce(level, F.lit(0)) < 1, "bad_hierarchy_level"),
        F.when(F.length(F.trim(title)) < 2, "short_title"),
    ))


def validated_sections(records: DataFrame, required: dict[str, Sequence[str]] = REQUIRED_TITLES, more: Sequence[Column] = ()) -> DataFrame:
    """Per report: its sections and those without a missing field, the required ones that no title names, all issues, ``more`` columns, and the score.

    An issue is ``at:what``: of section ``i``, or of its part ``i-j``. The score is the required sections found and one point for any
    part, of all points.
    """
    titles = F.transform("sections", lambda s: F.coalesce(s["title"], F.lit("")))

    def named(words: Sequence[str]) -> Column:
        return F.exists(titles, lambda t: any_of(t, words))

    missing = F.array_compact(F.array(*[F.when(~named(words), name) for name, words in required.items()]))

    def labelled(at: Column, s: Column) -> Column:
        return F.transform(section_field_issues(s), lambda what: F.concat(at, F.lit(":"), what))

    own = F.flatten(F.transform("sections", lambda s, i: labelled(i.cast("string"), s)))
    parts = F.flatten(F.transform("sections", lambda s, i: F.flatten(F.transform(s["subsections"], lambda p, j: labelled(F.concat_ws("-", i.cast("string"), j.cast("string")), p)))))
    valid = F.size(F.filter("sections", lambda s: ~F.exists(section_field_issues(s), lambda x: x.startswith("no_"))))
    n_parts = F.aggregate("sections", F.lit(0), lambda n, s: n + F.size(s["subsections"]))
    kinds = F.array_sort(F.array_distinct(F.transform("sections", lambda s: s["section_type"])))
    out = records.select(
        "page_id", F.size("sections").alias("total_sections"), valid.alias("valid_sections"), kinds.alias("section_types"), missing.alias("missing_sections"), n_parts.alias("total_subsections"),
        F.concat(F.transform(missing, lambda m: F.concat(F.lit("missing:"), m)), own, parts).alias("issues"), *more,
    )
    points = F.lit(len(required)) - F.size("missing_sections") + F.when(F.col("total_subsections") > 0, 1).otherwise(0)
    return out.withColumn("score", points / (len(required) + 1))


def validated_main_sections(sections_: DataFrame, key: str, kind: str = "section_type", title: str = "title", details: str = "n_details", tables: str = "n_tables", required: Sequence[str] = REQUIRED_TYPES) -> DataFrame:
    """The older layout of typed sections with detailed notes, per report: counts, issues, score.

    Issues: ``no_<type>`` for a required type that no section has; ``no_details`` where sections of notes are there, but none has details.
    """
    out = sections_.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_sections"), F.array_sort(F.collect_set(F.coalesce(kind, F.lit("UNKNOWN")))).alias("section_types"),
        F.coalesce(F.sum(details), F.lit(0)).alias("details"), F.coalesce(F.sum(tables), F.lit(0)).alias("tables"), F.bool_or(F.coalesce(F.col(title).contains(NOTES), F.lit(False))).alias("__notes"),
    )
    lacking = F.array_compact(F.array(*[F.when(~F.array_contains("section_types", t), f"no_{t}") for t in required]))
    bare = F.col("__notes") & (F.col("details") == 0)
    points = F.lit(len(required)) - F.size(lacking) + F.when(F.col("details") > 0, 1).otherwise(0)
    issues = F.concat(lacking, F.array_compact(F.array(F.when(bare, "no_details"))))
    return out.select(key, "total_sections", "section_types", "details", "tables", issues.alias("issues"), (points / (len(required) + 1)).alias("score"))


def validated_flat_sections(sections_: DataFrame, key: str, pos: str = "pos", required: Sequence[str] = tuple(REQUIRED_TITLES), keywords: Sequence[str] = FINANCIAL_KEYWORDS) -> DataFrame:
    """The oldest layout of flat sections ``(title, level, section_number, content, n_subsections)``, per report: counts, issues, warnings.

    ``issues``: required titles that are missing, fields that a section lacks, ``unordered`` where a section's number is smaller
    than that before it (none counts as 0). ``warnings``: sections without content or without a financial word, notes (number 2) without parts.
    """
    title, content = F.coalesce("title", F.lit("")), F.trim(F.coalesce("content", F.lit("")))
    number = F.coalesce("section_number", F.lit(0))
    before = F.lag(number).over(W.partitionBy(key).orderBy(pos))
    fields = F.array_compact(F.array(*[F.when(F.col(f).isNull(), f"no_{f}") for f in ("title", "level", "section_number", "content")]))
    bare = (F.col("section_number") == 2) & title.contains(NOTES) & (F.coalesce("n_subsections", F.lit(0)) == 0)
    warnings = F.array_compact(F.array(
        F.when(F.col("content").isNotNull() & (content == ""), "empty_content"), F.when((content != "") & ~any_of(content, keywords), "no_financial_word"), F.when(bare, "notes_without_parts"),
    ))
    rows = sections_.withColumns({"__fields": fields, "__warnings": warnings, "__back": F.coalesce(before > number, F.lit(False))})
    found = {w: F.bool_or(title.contains(w)) for w in required}
    missing = F.array_compact(F.array(*[F.when(~f, f"missing_{w}") for w, f in found.items()]))

    def each(column: str) -> Column:
        listed = F.array_sort(F.collect_list(F.when(F.size(column) > 0, F.struct(pos, column))))
        return F.flatten(F.transform(listed, lambda x: F.transform(x[column], lambda what: F.concat(x[pos].cast("string"), F.lit(":"), what))))

    out = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_sections"), F.count_if(F.size("__fields") == 0).alias("valid_sections"), missing.alias("__missing"), each("__fields").alias("__own"),
        each("__warnings").alias("warnings"), F.bool_or("__back").alias("__back"),
    )
    issues = F.concat("__missing", "__own", F.array_compact(F.array(F.when(F.col("__back"), "unordered"))))
    return out.select(key, "total_sections", "valid_sections", issues.alias("issues"), "warnings")


def bracketed_amounts(cells: DataFrame, key: Sequence[str] = ("table_id",)) -> DataFrame:
    """Per table: the cells whose figures stand in brackets, which is how negative amounts are printed."""
    figure = F.col("text").rlike(r"\d") & F.col("text").contains("(") & F.col("text").contains(")")
    return cells.groupBy(*key).agg(F.count_if(figure).alias("bracketed"))


def validated_reports(records: DataFrame, tables: DataFrame | None = None, required: dict[str, Sequence[str]] = REQUIRED_TITLES) -> DataFrame:
    """Per report: the validation of its sections and of its ``tables(page_id, status, is_financial)``, the year's agreement, and the overall score.

    Without them, tables are an array of such structs in the records. The score weighs the sections' with 0.6, the share of valid tables (1 without any)
    with 0.3 and 1 less 0.05 for each issue of the record's structure with 0.1. An issue of the structure is a year that the name has and the record has not,
    or a different one.
    """
    kinds = {"total_tables": lambda t: F.lit(True), "valid_tables": lambda t: t["status"] == "valid", "financial_tables": lambda t: t["is_financial"], "empty_tables": lambda t: t["status"] == "empty"}
    year = F.regexp_extract("metadata.source_file", r"(\d{4})", 1).try_cast("int")
    basic = F.array_compact(F.array(
        F.when(F.col("metadata.report_year").isNull(), "no_report_year"), F.when(year != F.col("metadata.report_year"), "other_year"), F.when(F.size("sections") == 0, "no_sections"),
    ))
    issues = basic.alias("structure_issues")
    if tables is None:
        both = validated_sections(records, required, [issues, *[F.size(F.filter("tables", of)).cast("long").alias(name) for name, of in kinds.items()]])
    else:
        counted = tables.groupBy("page_id").agg(*[F.count_if(of({c: F.col(c) for c in ("status", "is_financial")})).alias(name) for name, of in kinds.items()])
        both = validated_sections(records, required, [issues]).join(counted, "page_id", "left").na.fill(0, list(kinds))
    share = F.when(F.col("total_tables") > 0, F.col("valid_tables") / F.col("total_tables")).otherwise(1.0)
    score = 0.6 * F.col("score") + 0.3 * share + 0.1 * (1 - 0.05 * F.size("structure_issues"))
    return both.withColumn("overall_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


#: Fields that a parsed report must have, and the types that they may be of: VARIANT type names, or their beginnings (fixed values).
FIELDS = {"version": None, "source_filename": None, "report_year": ("BIGINT", "VOID"), "sections": ("ARRAY",), "tables": ("ARRAY",)}


def typed_structure(reports_: DataFrame, key: str, json: str, fields: dict = FIELDS) -> DataFrame:
    """``(key, issue)`` of parsed reports as JSON: fields that are not there, or of a wrong type; ``corrupt`` for what is no JSON object.

    A corrupt or missing report does not stop the others. A field that is null is there.
    """
    v = F.try_parse_json(F.col(json))
    present = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    issues = []
    for name, types in fields.items():
        there = F.array_contains(present, name)
        issues.append(F.when(~there, f"no_{name}"))
        if types:
            of = F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))
            fits = F.lit(False)
            for t in types:
                fits = fits | of.startswith(t)
            issues.append(F.when(there & ~F.coalesce(fits, F.lit("VOID" in types)), f"bad_{name}"))
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return reports_.select(key, F.explode(F.when(whole, F.array_compact(F.array(*issues))).otherwise(F.array(F.lit("corrupt")))).alias("issue"))


#: Nodes that a report is expected to make besides its notes: company, subsidiary, statements, years, categories, search documents (fixed values).
PLANNED = {"company": 1, "subsidiary": 1, "fs_sections": 4, "year_nodes": 4, "categories": 20, "search_docs": 10}


def planned_load(records: DataFrame) -> DataFrame:
    """What a load of reports would make, by file and in all (``TOTAL``): sections, notes, and estimates of nodes and twice as many edges."""
    notes = F.size(F.filter("sections", lambda s: s["title"].contains(NOTES)))
    rows = records.select("metadata.source_file", F.size("sections").alias("sections"), notes.alias("notes")).withColumn("n", F.col("notes") + sum(PLANNED.values()))
    sums = [F.sum(a).alias(b) for a, b in (("sections", "sections"), ("notes", "notes"), ("n", "estimated_nodes"))]
    return rows.rollup("source_file").agg(*sums).withColumns({"source_file": F.coalesce("source_file", F.lit("TOTAL")), "estimated_edges": 2 * F.col("estimated_nodes")})


def report_lines(validated: DataFrame) -> DataFrame:
    """The text report of a validation, a row per line: ``page_id, line, text``."""
    def line(label: str, value: Column) -> Column:
        return F.array(F.concat(F.lit(label), value.cast("string")))

    def head(text: str) -> Column:
        return F.array(F.lit(text))

    missing, every = F.col("missing_sections"), F.concat("structure_issues", "issues")
    parts = [
        head("=== 데이터 검증 리포트 ==="), head(""), F.array(F.concat(F.lit("전체 품질 점수: "), F.format_number("overall_score", 2), F.lit("/1.00"))), head(""),
        head("=== 섹션 검증 결과 ==="), line("총 섹션 수: ", F.col("total_sections")), line("유효한 섹션 수: ", F.col("valid_sections")),
        F.when(F.size(missing) > 0, F.array(F.concat(F.lit("누락된 섹션: "), F.array_join(missing, ", ")))).otherwise(F.array().cast("array<string>")), head(""),
        head("=== 테이블 검증 결과 ==="), line("총 테이블 수: ", F.col("total_tables")), line("유효한 테이블 수: ", F.col("valid_tables")),
        line("재무 테이블 수: ", F.col("financial_tables")), line("빈 테이블 수: ", F.col("empty_tables")), head(""),
        F.when(F.size(every) > 0, F.concat(head("=== 발견된 문제점 ==="), F.transform(every, lambda i: F.concat(F.lit("- "), i)), head(""))).otherwise(F.array().cast("array<string>")),
    ]
    return validated.select("page_id", F.posexplode(F.concat(*parts)).alias("line", "text"))
