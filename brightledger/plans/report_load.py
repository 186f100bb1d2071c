"""The load of reports: from pages to audits, notes, search documents and the edges of all of them.

Pages are tokenised once; their blocks are written, since sections, tables and notes all come of them, and so are nodes, which edges come of. Everything after that is by
section, so a report's size bounds what one key holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.functions.ids import node_id
from brightledger.operators import notes as N
from brightledger.operators import report_tree, reports, search, upsert
from brightledger.operators.statement_tables import looks_financial
from brightledger.sources.scratch import written

# --- fixed values: words of audit titles, and least lengths
AUDIT_WORDS = ("감사", "audit", "독립", "의견", "내부회계", "검토")
LEAST_AUDIT, LONG_AUDIT, LEAST_CELL = 100, 500, 3
LEAST_SECTION, LEAST_CLEAN, LEAST_NOTE, LEAST_TABLE, LEAST_ROWS = 50, 30, 20, 50, 2


def edge(src, dst, kind: str) -> tuple:
    return (F.col(src) if isinstance(src, str) else src).alias("src_id"), (F.col(dst) if isinstance(dst, str) else dst).alias("dst_id"), F.lit(kind).alias("rel_type")


def audit_facts(sections: DataFrame, cells: DataFrame) -> DataFrame:
    """``company, year, audit_type, seq, auditor, opinion, audit_date`` of the sections whose titles speak of an audit.

    Sections without tables and with little text are passed over. Auditor and date are those of the text, else of the first
    cell that names one; sections that name nothing count only where they are long.
    """
    spoken = sections.where(T.any_of(F.lower(F.col("title")), AUDIT_WORDS) & ((F.length("content") >= LEAST_AUDIT) | (F.col("n_tables") > 0)))
    at = F.struct("table_index", "row_index", "col_index")
    who, when = F.when(F.length(F.trim("text")) >= LEAST_CELL, T.auditor("text")), T.iso_date("text")
    shown = cells.groupBy("page_id", F.col("section_pos").alias("pos")).agg(
        F.min(F.when(who.isNotNull(), F.struct(at.alias("at"), who.alias("v")))).alias("__who"), F.min(F.when(when.isNotNull(), F.struct(at.alias("at"), when.alias("v")))).alias("__when")
    )
    read = spoken.join(shown, ["page_id", "pos"], "left").withColumns({
        "auditor": F.coalesce(T.auditor("content"), F.col("__who.v")), "opinion": T.audit_opinion("content"), "audit_date": F.coalesce(T.iso_date("content"), F.col("__when.v")), "audit_type": T.audit_type("title"),
    })
    some = F.coalesce("auditor", "opinion", "audit_date").isNotNull() | (F.length("content") > LONG_AUDIT)
    return read.where(some).select("company", "year", "audit_type", F.struct("page_id", "pos").alias("seq"), "auditor", "opinion", "audit_date")


def table_documents(cells: DataFrame) -> DataFrame:
    """Search documents of tables with two rows and enough text: the section's title, then a line for each row."""
    key = ["company", "year", "page_id", "section_id", "section_pos", "title", "table", "table_index"]
    told = F.array_sort(F.collect_list(F.when(F.trim("text") != "", F.struct("col_index", F.trim("text").alias("t")))))
    rows = cells.groupBy(*key, "row_index").agg(F.array_join(F.transform(told, lambda c: c["t"]), " ").alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_index", "line"))), lambda r: r["line"])
    whole = rows.groupBy(*key).agg(lines.alias("lines"), F.count(F.lit(1)).alias("row_count"))
    financial = looks_financial(cells.withColumn("column_name", F.lit("")), key=("page_id", "table_index"))
    found = whole.where(F.col("row_count") >= LEAST_ROWS).join(financial, ["page_id", "table_index"])
    text = F.concat_ws("\n", F.concat(F.lit("Table from: "), F.col("title")), F.array_join(F.filter("lines", lambda x: x != ""), "\n"))
    name = F.concat(F.lit("Table "), (F.col("table") + 1).cast("string"), F.lit(" from "), F.col("title"), F.when(F.col("financial"), " (Financial)").otherwise(""))
    anchor = F.concat_ws("_", F.lit("table"), "section_id", F.col("table").cast("string"), F.col("year").cast("string"))
    return search.documents(found.select("company", "year", name.alias("title"), text.alias("text"), anchor.alias("anchor")), "table", "title", "text", "anchor", "year", LEAST_TABLE, keep=["company"])


def report_tables(pages: DataFrame, company: str = "company", year: str = "year") -> dict[str, DataFrame]:
    """Node and edge tables of reports ``(page_id, company, year, html)``.

    ``sections, notes, note_categories, audits, auditors, search_documents`` and their edges: has_note, has_note_category,
    has_audit_info, audited_by and related_to, from companies to documents and from notes to theirs.
    """
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col(company).alias("company"), F.col(year).cast("int").alias("year"))
    blocks = written(reports.blocks(pages))
    tree = written(report_tree.section_tree(blocks).join(named, "page_id"))
    cells = written(report_tree.section_cells(blocks, tree).join(named, "page_id"))
    # --- notes, numbered in the notes' sections
    parts = N.split_notes(tree.where(F.col("section_id") == report_tree.NOTES_ID).withColumn("key", F.struct("company", "year", "page_id", F.col("pos").alias("section_pos"))), "key", "content")
    said = parts.select("key.company", "key.year", "note_number", F.struct("key.page_id", "key.section_pos", "pos").alias("seq"), "title", F.col("body").alias("content"))
    longest = said.where(F.length(F.trim("content")) >= LEAST_NOTE).groupBy("company", "year", "note_number").agg(F.max(F.struct(F.length("content").alias("n"), "content", "title")).alias("b"))
    notes = longest.select("company", "year", "note_number", "b.title", "b.content").withColumn("id", node_id("note"))
    notes = written(N.classified(notes, "title", "content"))
    kinds = notes.select("id", F.explode(F.array_distinct(F.array("category", "subcategory"))).alias("note_category"))
    categories = kinds.select("note_category").distinct().withColumn("id", node_id("note_category"))
    # --- audits
    audits = upsert.first_filled(audit_facts(tree, cells), ["company", "year", "audit_type"], ["auditor", "opinion", "audit_date"]).withColumn("id", node_id("audit_info"))
    audits = written(audits)
    by = audits.where(F.col("auditor").isNotNull())
    auditors = by.select("auditor").distinct().withColumn("id", node_id("auditor"))
    # --- search documents
    anchored = tree.where(F.length(F.trim("content")) >= LEAST_SECTION).withColumn("anchor", F.concat(F.lit("section_"), F.col("section_id")))
    of_sections = search.documents(anchored, "section", "title", "content", "anchor", "year", LEAST_CLEAN, keep=["company"])
    note_anchor = F.concat(F.lit("note_"), F.col("note_number").cast("string"))
    of_notes = search.documents(notes.withColumn("anchor", note_anchor), "note", "title", "content", "anchor", "year", LEAST_SECTION, keep=["company", "note_number"])
    every = of_sections.unionByName(of_notes, allowMissingColumns=True).unionByName(table_documents(cells), allowMissingColumns=True)
    # A report that says a thing twice has it once.
    documents = every.withColumn("id", node_id("search_doc")).groupBy("id").agg(F.max(F.struct(*every.columns)).alias("d")).select("id", "d.*")
    documents = written(documents)
    companies = named.select("company").distinct().withColumn("id", node_id("company"))
    edges = [
        notes.select(*edge(node_id("company"), "id", "has_note")), kinds.select(*edge("id", node_id("note_category"), "has_note_category")), audits.select(*edge(node_id("company"), "id", "has_audit_info")),
        by.select(*edge(node_id("company"), node_id("auditor"), "audited_by")), documents.select(*edge(node_id("company"), "id", "related_to")), documents.where("note_number is not null").select(*edge(node_id("note"), "id", "related_to")),
    ]
    made = {"companies": companies, "sections": tree, "notes": notes, "note_categories": categories, "audits": audits, "auditors": auditors, "search_documents": documents}
    ids = reduce(DataFrame.unionByName, [t.select("id") for n, t in made.items() if n != "sections"]).distinct()
    return made | {"edges": upsert.existing_edges(reduce(DataFrame.unionByName, edges), ids, ids)}
