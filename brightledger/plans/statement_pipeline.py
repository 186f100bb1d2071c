"""The whole load in dependency order: nodes first, then the edges between those that exist.

Tables are chained lazily and written once each, and measured as they are; the statement values, which most others use, are cached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.functions.ids import node_id
from brightledger.functions.note_words import NOTE_CATEGORIES, NOTE_SUBCATEGORIES
from brightledger.operators import notes as N
from brightledger.operators import relations, search, trends, upsert
from brightledger.operators.metrics import RunMetrics
from brightledger.sources import tables
from brightledger.sources.store import Store

COMPANY = "company"
#: Least characters of a search document, and of an audit section that names nothing.
LEAST_DOCUMENT, LEAST_AUDIT = 50, 500


def edge(src, dst, kind: str) -> tuple:
    return (F.col(src) if isinstance(src, str) else src).alias("src_id"), (F.col(dst) if isinstance(dst, str) else dst).alias("dst_id"), F.lit(kind).alias("rel_type")


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


#: Types of the edges between companies, statements, years and data.
EDGE_TYPES = ("contains_data", "has_year_data", "has_financial_statement", "precedes")


def build(facts: DataFrame, company: str = COMPANY, metrics: RunMetrics | None = None) -> dict[str, DataFrame]:
    """Node and edge tables of statement values ``(item_name, section_code, year, value)``; ``metrics`` counts the edges that are tried."""
    facts = facts.withColumn("company", F.lit(company))
    companies = facts.sparkSession.range(1).select(F.lit(company).alias("company")).withColumn("id", node_id("company"))
    sections = facts.select("company", "section_code").distinct().withColumn("id", node_id("fs_section"))
    years = facts.select("company", "section_code", "year").distinct().withColumn("id", node_id("year_node"))
    data = facts.withColumn("id", node_id("financial_data", column_name="section_code"))
    trend = trends.all_trends(facts, ["company", "item_name", "section_code"])
    yearly = F.when(F.col("trend_type") == "year_over_year", F.concat_ws("_", "trend_type", "current_year")).otherwise(F.col("trend_type"))
    trend = trend.withColumn("id", node_id("financial_trend", trend_type=yearly))
    year_of = years.select("company", "section_code", "year", F.col("id").alias("src_id"))
    holds = data.join(year_of, ["company", "section_code", "year"]).select("src_id", F.col("id").alias("dst_id"), F.lit("contains_data").alias("rel_type"))
    in_section = years.join(sections.select("company", "section_code", F.col("id").alias("src_id")), ["company", "section_code"])
    has_year = in_section.select("src_id", F.col("id").alias("dst_id"), F.lit("has_year_data").alias("rel_type"))
    has_section = sections.select(*edge(node_id("company"), "id", "has_financial_statement"))
    pairs = trends.consecutive_years(facts)
    first = year_of.select("section_code", "year", "src_id")
    nxt = year_of.select("section_code", F.col("year").alias("next_year"), F.col("src_id").alias("dst_id"))
    follows = pairs.join(first, ["section_code", "year"]).join(nxt, ["section_code", "next_year"]).select("src_id", "dst_id", F.lit("precedes").alias("rel_type"))
    ids = _all([t.select("id") for t in (companies, sections, years, data)]).distinct()
    tried = (lambda df: metrics.attempted("edges", df, "rel_type", EDGE_TYPES)) if metrics else (lambda df: df)
    edges = upsert.existing_edges(_all([holds, has_year, has_section, follows]), ids, ids, attempted=tried)
    return {"companies": companies, "sections": sections, "years": years, "data": data, "trends": trend, "edges": edges}


def note_tables(notes: DataFrame, categories: dict, subcategories: dict) -> dict[str, DataFrame]:
    """Merged notes of ``(company, year, note_number, seq, title, content)``, their categories, and the edges of both."""
    merged = N.merge_notes(notes, ["company", "year"], "note_number", "seq", "content").withColumn("id", node_id("note"))
    nodes = N.classified(merged, None, "text", categories, subcategories)
    names = N.category_names(nodes).withColumn("id", node_id("note_category"))
    has_note = nodes.select(*edge(node_id("company"), "id", "has_note"))
    kinds = nodes.select("id", F.explode(F.array_distinct(F.array("category", "subcategory"))).alias("note_category"))
    has_category = kinds.select(*edge("id", node_id("note_category"), "has_note_category"))
    return {"notes": nodes, "note_categories": names, "note_edges": has_note.unionByName(has_category).distinct()}


def category_tables(paths: DataFrame) -> dict[str, DataFrame]:
    """Categories ``(company, section_code, category_path, level, name)`` with search keys, and the edges from their sections."""
    first = paths.groupBy("company", "section_code", "category_path").agg(F.min("level").alias("level"), F.min("name").alias("name"))
    nodes = first.withColumns({"id": node_id("category"), **T.path_keys("category_path")})
    return {"categories": nodes, "category_edges": nodes.select(*edge(node_id("fs_section"), "id", "has_category"))}


def audit_tables(sections: DataFrame) -> dict[str, DataFrame]:
    """Audit facts of sections ``(company, year, seq, title, content)`` that name one or are long, the auditors, and their edges."""
    said = {"auditor": T.auditor("content"), "opinion": T.audit_opinion("content"), "audit_date": T.iso_date("content"), "audit_type": T.audit_type("title")}
    facts = sections.withColumns(said).where(F.coalesce("auditor", "opinion", "audit_date").isNotNull() | (F.length("content") > LEAST_AUDIT))
    keys = ["company", "year", "audit_type"]
    nodes = upsert.first_filled(facts, keys, ["auditor", "opinion", "audit_date"]).withColumn("id", node_id("audit_info"))
    named = nodes.where(F.col("auditor").isNotNull())
    auditors = named.select("auditor").distinct().withColumn("id", node_id("auditor"))
    has_info = nodes.select(*edge(node_id("company"), "id", "has_audit_info"))
    by = named.select(*edge(node_id("company"), node_id("auditor"), "audited_by"))
    return {"audits": nodes, "auditors": auditors, "audit_edges": has_info.unionByName(by).distinct()}


def relation_tables(rows: DataFrame, owned: DataFrame, company: str = COMPANY) -> dict[str, DataFrame]:
    """Companies ``(name, percent, kind, seq)`` with the typed edges of ownership, and relations ``rows`` merged by pair and kind."""
    nodes, edges = relations.company_graph(relations.companies(owned, "name", "percent", "kind", "seq"), company, "name")
    return {"related_companies": nodes, "ownership_edges": edges, "relations": relations.all_relations([rows])}


def search_tables(notes: DataFrame, nodes: DataFrame, least: int = LEAST_DOCUMENT) -> dict[str, DataFrame]:
    """Search documents of notes, and the edges to them from their companies and from the note ``nodes`` that there are."""
    key = F.concat_ws("-", F.col("note_number").cast("string"), F.col("seq").cast("string"))
    docs = search.documents(notes.withColumn("anchor", key), "note", "title", "content", "anchor", "year", least, keep=["company", "note_number"])
    docs = docs.withColumn("id", node_id("search_doc"))
    from_note = docs.select(*edge(node_id("note"), "id", "related_to")).join(nodes.select(F.col("id").alias("src_id")), "src_id", "left_semi")
    from_company = docs.select(*edge(node_id("company"), "id", "related_to"))
    return {"search_documents": docs, "search_edges": from_note.unionByName(from_company)}


def load_tables(
    spark: SparkSession, source: str, facts: DataFrame, years: list[int] | None, categories: dict, subcategories: dict, metrics: RunMetrics | None = None
) -> dict[str, DataFrame]:
    """All tables of a folder's load: statements, categories, notes, audits, companies, relations and search documents."""
    made = build(facts, metrics=metrics)
    notes = tables.notes(spark, source)
    links = tables.company_edges(spark, source, years)
    if years is not None:
        notes = notes.where(F.col("year").isin(years))
    names = F.split("item_name", " ")
    paths = facts.select(
        F.lit(COMPANY).alias("company"), "section_code", F.array_join(names, ">").alias("category_path"), F.size(names).alias("level"), F.element_at(names, -1).alias("name"), "item_name"
    ).distinct()
    made |= category_tables(paths)
    holds = made["data"].join(paths.select("section_code", "item_name", "category_path"), ["section_code", "item_name"]).select(*edge(node_id("category"), "id", "related_to"))
    made["category_edges"] = made["category_edges"].unionByName(holds)
    made |= note_tables(notes, categories, subcategories) | audit_tables(notes) | search_tables(notes, note_nodes(notes))
    rows = links.withColumns({"seq": F.col("order_key") * 10 + F.col("line_number"), "transaction_type": F.lower("priority"), "amount": F.col("amount").cast("double")})
    owned = rows.select(F.col("dst_id").alias("name"), F.lit(None).cast("double").alias("percent"), F.col("rel_type").alias("kind"), "seq")
    made |= relation_tables(rows.select("src_id", "dst_id", "rel_type", "transaction_type", "amount", "seq"), owned)
    others = notes.select("company").distinct().withColumn("id", node_id("company"))
    made["companies"] = made["companies"].unionByName(others).distinct()
    return made


def note_nodes(notes: DataFrame) -> DataFrame:
    """The ids that merged notes get, without merging them."""
    kept = notes.where(F.length(F.trim("content")) >= 20)
    return kept.select(node_id("note").alias("id")).distinct()


def run_pipeline(
    spark: SparkSession, source: str, store_path: str, years: list[int] | None = None, categories: dict = NOTE_CATEGORIES, subcategories: dict = NOTE_SUBCATEGORIES
) -> DataFrame:
    """Loads a folder's statements and notes into the next version of a store; returns what each table's write did, edges by type.

    ``years`` reaches the scan of what is dated, and the metrics are kept beside the store, in ``metrics`` by version.
    """
    facts = tables.statements(spark, source, years).cache()
    metrics = RunMetrics(spark)
    try:
        version = Store(spark, store_path).write(load_tables(spark, source, facts, years, categories, subcategories, metrics), metrics=metrics)
    finally:
        facts.unpersist()
    metrics.save(f"{store_path}/metrics/{version}")
    done = metrics.frame()
    return done.select(F.col("operation").alias("table"), "kind", F.col("processed_items").alias("n"), *done.columns[2:])
