"""Notes and search documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.operators import notes as N
from brightledger.operators import search
from brightledger.plans.registry import query
from brightledger.sources.tables import NOTES_SQL, CELLS_SQL, cells, notes, table

PATTERNS = {"law": ("the", "ing", "tion"), "trade": ("der", "keit", "ver"), "risk": ("que", "eau"), "audit": ("los", "ción")}
YEARS = ["company", "year"]


def _hits(words) -> str:
    return "(" + " + ".join(f"CAST(contains(content, '{w}') AS INT)" for w in words) + ")"


SCORED = f"""scored AS (SELECT company, year, note_number, seq, {', '.join(f'{_hits(w)} AS {c}' for c, w in PATTERNS.items())} FROM notes), classed AS (
  SELECT company, year, note_number, seq, CASE WHEN greatest(law, trade, risk, audit) = law THEN 'law' WHEN greatest(law, trade, risk, audit) = trade THEN 'trade' WHEN greatest(law, trade, risk, audit) = risk THEN 'risk' ELSE 'audit' END AS category,
    law, trade, risk, audit FROM scored
), classified AS (
  SELECT company, year, note_number, seq, category, round(CASE category WHEN 'law' THEN law / 3.0 WHEN 'trade' THEN trade / 3.0 WHEN 'risk' THEN risk / 2.0 ELSE audit / 2.0 END, 6) AS confidence FROM classed
)"""


@query(
    "a7_note_merge",
    f"""WITH {NOTES_SQL}, k AS (SELECT * FROM notes WHERE length(trim(content)) >= 20)
SELECT company, year, note_number, CASE WHEN note_number = 2 THEN string_agg(content, chr(10) || chr(10) ORDER BY seq) ELSE (max({{'n': length(content), 's': -seq, 'c': content}})).c END AS text, count(*) AS merged_sources,
  CASE WHEN count(*) > 10 THEN 'high' WHEN count(*) > 5 THEN 'medium' WHEN count(*) > 1 THEN 'low' ELSE 'single' END AS merge_quality FROM k GROUP BY 1, 2, 3""",
)
def note_merge(spark, d):
    """One note per company, year and number."""
    return N.merge_notes(notes(spark, d), YEARS, "note_number", "seq", "content")


def _classified(spark, d):
    c = N.classify(notes(spark, d), "content", PATTERNS)
    return c.withColumn("confidence", F.round("confidence", 6)).select("company", "year", "note_number", "seq", "category", "confidence")


@query("a8_note_classes", f"WITH {NOTES_SQL}, {SCORED} SELECT * FROM classified")
def note_classes(spark, d):
    """Notes by category of keywords."""
    return _classified(spark, d)


PARTS = {"law": {"article": ("the", "a "), "ending": ("ing", "ed "), "noun": ("tion",)}, "trade": {"case": ("der", "dem"), "prefix": ("ver", "ge")}}
PART_HITS = {category: {name: _hits(words) for name, words in parts.items()} for category, parts in PARTS.items()}


def _best_part(hits: dict[str, str]) -> str:
    top = f"greatest({', '.join(hits.values())})"
    return f"CASE WHEN {top} = 0 THEN 'general' " + " ".join(f"WHEN {h} = {top} THEN '{name}'" for name, h in hits.items()) + " END"


@query(
    "a8_note_subcategories",
    f"""WITH {NOTES_SQL}, {SCORED} SELECT c.seq, c.category, CASE c.category {' '.join(f"WHEN '{c}' THEN {_best_part(h)}" for c, h in PART_HITS.items())} ELSE 'general' END AS subcategory
FROM classified c JOIN notes n ON c.seq = n.seq""",
)
def note_subcategories(spark, d):
    """Notes by category and, within it, by the subcategory most of whose words they have."""
    c = N.classify(notes(spark, d), "content", PATTERNS)
    return N.subclassify(c, "content", PARTS, "general").select("seq", "category", "subcategory")


@query(
    "a9_classification_summary",
    f"""WITH {NOTES_SQL}, {SCORED} SELECT category, year, CAST(grouping(category, year) AS BIGINT) AS "grouping", count(*) AS n, round(avg(confidence), 6) AS avg_confidence, min(confidence) AS min_confidence, max(confidence) AS max_confidence
FROM classified GROUP BY GROUPING SETS ((category), (year), (category, year), ())""",
)
def classification_summary(spark, d):
    """Classes by category, year, both and in all."""
    s = N.classification_summary(_classified(spark, d), "category", "year", "confidence")
    return s.withColumn("avg_confidence", F.round("avg_confidence", 6))


@query(
    "j7_classified_notes",
    f"""WITH {NOTES_SQL}, {SCORED}, a AS (SELECT DISTINCT year, note_number FROM notes WHERE year < 2020), b AS (SELECT year, note_number, (max({{'s': seq, 'c': category}})).c AS category FROM classified WHERE year > 2016 GROUP BY 1, 2)
SELECT coalesce(a.year, b.year) AS year, coalesce(a.note_number, b.note_number) AS note_number, category FROM a FULL JOIN b ON a.year = b.year AND a.note_number = b.note_number""",
)
def classified_notes(spark, d):
    """Notes with their latest class, and classes of missing notes."""
    n = notes(spark, d).where("year < 2020").select("year", "note_number").distinct()
    return N.merge_classified(n, _classified(spark, d).where("year > 2016"), ["year", "note_number"], "seq", ["category"])


@query(
    "j4_data_note_edges",
    f"""WITH {NOTES_SQL}, {CELLS_SQL}, r AS (SELECT table_id, row_index, CAST(2014 + table_id % 11 AS INTEGER) AS year, unnest(string_split(text, ', ')) AS n FROM cells WHERE col_index = 1)
SELECT r.table_id, r.row_index, r.year, x.note_number, count(*) AS n FROM r JOIN (SELECT DISTINCT year, note_number FROM notes) x ON x.year = r.year AND x.note_number = CAST(r.n AS INT) GROUP BY 1, 2, 3, 4""",
)
def data_note_edges(spark, d):
    """Edges from statement rows to the notes that they name."""
    from brightledger.functions.text import note_reference

    rows = cells(spark, d).where("col_index = 1").select("table_id", "row_index", (F.lit(2014) + F.col("table_id") % 11).cast("int").alias("year"), note_reference("text").alias("numbers"))
    out = N.note_links(rows, notes(spark, d), "numbers", ["year"])
    return out.groupBy("table_id", "row_index", "year", "note_number").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j5_category_note_links",
    """WITH t AS (SELECT c_nationkey AS k, c_mktsegment AS name, c_name AS original, c_custkey AS id FROM customer), r AS (SELECT DISTINCT s_nationkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'none' END AS clean, 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS raw FROM supplier)
SELECT r.k, r.clean, r.raw, min(t.id) AS id FROM r JOIN t ON r.k = t.k AND (r.clean = t.name OR r.raw = t.original) GROUP BY 1, 2, 3""",
)
def category_note_links(spark, d):
    """References matched by clean name or by raw name."""
    t = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("name"), F.col("c_name").alias("original"), F.col("c_custkey").alias("id"))
    s = table(spark, d, "supplier")
    r = s.select(F.col("s_nationkey").alias("k"), F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("none").alias("clean"), F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("raw")).distinct()
    return N.matched_names(r, t, "k", "clean", "raw", "id", "name", "original")


@query("j6_containing_names", "SELECT n_name AS item, min(r_name || ' ' || n_name) AS name FROM nation JOIN region ON true GROUP BY 1 UNION ALL SELECT c_mktsegment, NULL FROM customer WHERE false")
def containing_names(spark, d):
    """The first name that contains each item."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    items = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("item"))
    names = n.select("n_name").crossJoin(r.select("r_name")).select(F.concat_ws(" ", "r_name", "n_name").alias("name"))
    return N.containing_names(items, names, "item", "name")


@query("j8_notes_of_known_years", f"WITH {NOTES_SQL} SELECT seq, year FROM notes WHERE year IN (SELECT CAST(year(o_orderdate) + 20 AS INTEGER) FROM orders)")
def notes_of_known_years(spark, d):
    """Notes of years that have reports."""
    known = table(spark, d, "orders").select((F.year("o_orderdate") + 20).alias("year")).distinct()
    return notes(spark, d).join(known, "year", "left_semi").select("seq", "year")


@query("q15_note_search", f"WITH {NOTES_SQL} SELECT seq, year, note_number, title FROM notes WHERE (contains(title, 'th') OR contains(content, 'ingly')) AND note_number IN (1, 3) ORDER BY seq LIMIT 50")
def note_search(spark, d):
    """Notes with a word in title or content, of some numbers."""
    hit = F.col("title").contains("th") | F.col("content").contains("ingly")
    return notes(spark, d).where(hit & F.col("note_number").isin(1, 3)).select("seq", "year", "note_number", "title").orderBy("seq").limit(50)


@query("q22_note_histogram", f"WITH {NOTES_SQL} SELECT note_number, count(*) AS n, count(DISTINCT year) AS years, count(DISTINCT company) AS companies FROM notes GROUP BY 1")
def note_histogram(spark, d):
    """Notes by number."""
    return notes(spark, d).groupBy("note_number").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("year").alias("years"), F.count_distinct("company").alias("companies"))


@query("q26_notes_of_year", f"WITH {NOTES_SQL} SELECT company, note_number, count(*) AS n FROM notes WHERE year = 2018 GROUP BY 1, 2")
def notes_of_year(spark, d):
    """Notes of a year by company and number."""
    return notes(spark, d).where("year = 2018").groupBy("company", "note_number").agg(F.count(F.lit(1)).alias("n"))


@query("q6_items_with_notes", f"WITH {NOTES_SQL} SELECT company, year, string_agg(DISTINCT CAST(note_number AS VARCHAR), ',' ORDER BY CAST(note_number AS VARCHAR)) AS numbers, count(*) AS n FROM notes GROUP BY 1, 2 ORDER BY n DESC, company, year LIMIT 20")
def items_with_notes(spark, d):
    """Companies and years with most notes, and their numbers."""
    g = notes(spark, d).groupBy("company", "year").agg(F.array_join(F.array_sort(F.collect_set(F.col("note_number").cast("string"))), ",").alias("numbers"), F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), "company", "year").limit(20)


@query(
    "h9_numbered_notes",
    """SELECT o_orderkey, 1 AS note_number, '일반 ' || o_orderpriority AS title, '본문' AS body FROM orders UNION ALL SELECT o_orderkey, 2, '회계정책', CAST(o_custkey AS VARCHAR) FROM orders""",
)
def numbered_notes(spark, d):
    """Numbered notes split out of running text."""
    t = F.concat(F.lit("머리\n1. 일반 "), F.col("o_orderpriority"), F.lit(": 본문\n2. 회계정책\n"), F.col("o_custkey").cast("string"))
    o = table(spark, d, "orders").select("o_orderkey", t.alias("content"))
    return N.last_blocks(N.split_notes(o, "o_orderkey", "content"), "o_orderkey")


# The first 10,000 characters, blanks collapsed, letters, digits and basic punctuation only.
CLEAN = """trim(regexp_replace(regexp_replace(regexp_replace(substring({c}, 1, 10000), '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}\\p{{Z}}.,;:()\\-]', ' ', 'g'), ' +', ' ', 'g'))"""
SEARCH_SQL = f"""{NOTES_SQL}, {CELLS_SQL}, whole AS (
  SELECT 'note' AS doc_type, title, {CLEAN.format(c='content')} AS content, CAST(seq AS VARCHAR) AS anchor, year FROM notes
  UNION ALL SELECT 'table', 'table ' || CAST(table_id AS VARCHAR), {CLEAN.format(c='content')}, CAST(table_id AS VARCHAR), NULL FROM (
    SELECT table_id, string_agg(text, ' ' ORDER BY row_index, col_index, text) AS content FROM cells GROUP BY 1)
), docs AS (SELECT *, length(content) AS content_length, len(list_filter(string_split(content, ' '), lambda w: w <> '')) AS word_count FROM whole WHERE length(content) >= 50)"""


def _search_docs(spark, d):
    n = notes(spark, d)
    whole = search.documents(n, "note", "title", "content", "seq", "year", 50)
    rows = cells(spark, d).groupBy("table_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "col_index", "text"))), lambda c: c["text"]), " ").alias("content"))
    tables = rows.withColumns({"title": F.concat(F.lit("table "), F.col("table_id").cast("string")), "year": F.lit(None).cast("int")})
    return whole.unionByName(search.documents(tables, "table", "title", "content", "table_id", "year", 50))


@query("d11_search_documents", f"WITH {SEARCH_SQL} SELECT * FROM docs")
def search_documents(spark, d):
    """Search documents of notes and tables."""
    return _search_docs(spark, d)


def _sizes(by: str) -> str:
    return f"WITH {SEARCH_SQL} SELECT {by}, count(*) AS n, round(avg(content_length), 6) AS avg_length, round(avg(word_count), 6) AS avg_words, max(content_length) AS longest FROM docs GROUP BY 1"


def _statistics(spark, d, by: str):
    s = search.statistics(_search_docs(spark, d), by)
    return s.withColumns({c: F.round(c, 6) for c in ("avg_length", "avg_words")})


@query("a17_search_statistics", _sizes("doc_type"))
def search_statistics(spark, d):
    """Search documents by type, with their sizes."""
    return _statistics(spark, d, "doc_type")


@query("a17_search_years", _sizes("year"))
def search_years(spark, d):
    """Search documents by year, with their sizes."""
    return _statistics(spark, d, "year")


@query("a17_largest_documents", f"WITH {SEARCH_SQL} SELECT doc_type, anchor, content_length FROM docs ORDER BY content_length DESC, doc_type, anchor LIMIT 5")
def largest_documents(spark, d):
    """The five longest search documents."""
    return search.largest(_search_docs(spark, d)).select("doc_type", "anchor", "content_length")


REQUIRED = {"statements": ("the", "der"), "notes": ("el ", "los"), "opinion": ("que",)}


@query(
    "v6_required_sections",
    f"""WITH {NOTES_SQL}, r AS (SELECT company, year, count(*) AS total_sections, {", ".join(f"bool_or({' OR '.join(f"contains(title, '{w}')" for w in words)}) AS {c}" for c, words in REQUIRED.items())},
  CAST(sum(CASE WHEN note_number = 2 THEN 1 ELSE 0 END) AS BIGINT) AS total_subsections FROM notes GROUP BY 1, 2)
SELECT company, year, total_sections, total_subsections, {" || ".join(f"CASE WHEN coalesce({c}, false) THEN '' ELSE '{c};' END" for c in REQUIRED)} AS missing,
  round(({" + ".join(f"CAST(coalesce({c}, false) AS INTEGER)" for c in REQUIRED)} + CAST(total_subsections > 0 AS INTEGER)) / 4.0, 6) AS score FROM r""",
)
def required_sections(spark, d):
    """What each report lacks of the required sections, with its score."""
    from brightledger.operators import reports

    part = F.when(F.col("note_number") == 2, 1).otherwise(0)
    out = reports.required_sections(notes(spark, d), ["company", "year"], "title", REQUIRED, part)
    missing = F.concat(F.array_join("missing", ";"), F.when(F.size("missing") > 0, ";").otherwise(""))
    return out.withColumns({"missing": missing, "score": F.round("score", 6)})


@query(
    "f23_search_text",
    "SELECT c_custkey, 'Customer (' || CAST(c_custkey AS VARCHAR) || ') 가나' AS clean FROM customer",
)
def search_texts(spark, d):
    """Text cleaned for search."""
    from brightledger.functions.text import search_text

    t = F.concat(F.lit("  Customer\t("), F.col("c_custkey").cast("string"), F.lit(")  ★ 가나 ◆ "))
    return table(spark, d, "customer").select("c_custkey", search_text(t).alias("clean"))
