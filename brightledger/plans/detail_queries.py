"""Details of statements, companies and notes: joins, searches, bundles and drawings that other queries leave open."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.functions.ids import node_id
from brightledger.operators import graph, notes, relations, reports, statement_tables, upsert
from brightledger.plans.registry import query
from brightledger.sources.tables import CATEGORIES_SQL, CELLS_SQL, EDGES_SQL, NOTES_SQL, STATEMENT_ROWS_SQL, STATEMENTS_SQL, categories, cells, company_edges, statement_rows, statements, table
from brightledger.sources.tables import notes as made_notes

# --- texts and encodings


@query(
    "s3_korean_encodings",
    "SELECT c_custkey, '보고서 ' || c_mktsegment || CASE WHEN c_custkey % 4 = 1 THEN ' 뷁' WHEN c_custkey % 4 = 2 THEN ' é' ELSE '' END AS text FROM customer WHERE c_custkey % 4 < 3 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 4 = 3",
)
def korean_encodings(spark, d):
    """Files in EUC-KR, in CP949 with a syllable that EUC-KR lacks, in UTF-8, and in none of them, decoded by the first that fits."""

    @F.pandas_udf("binary")
    def encoded(keys, texts):
        names = ("euc-kr", "cp949", "utf-8")
        return texts.combine(keys, lambda t, k: t.encode(names[k % 4]) if k % 4 < 3 else b"\xff\xff\xb0")

    k = F.col("c_custkey")
    said = F.concat(F.lit("보고서 "), F.col("c_mktsegment"), F.when(k % 4 == 1, " 뷁").when(k % 4 == 2, " é").otherwise(""))
    files = table(spark, d, "customer").select("c_custkey", encoded("c_custkey", said).alias("content"))
    return files.select("c_custkey", reports.decoded("content").alias("text"))


@query(
    "f18_loose_percentages",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 4 WHEN 0 THEN l_suppkey + 1.5 WHEN 1 THEN CAST(l_suppkey + 1 AS DOUBLE) WHEN 2 THEN -1 - l_suppkey END AS percentage FROM lineitem",
)
def loose_percentages(spark, d):
    """Percentages with signs and blanks in odd places."""
    n = (F.col("l_suppkey") + 1).cast("string")
    k = F.col("l_partkey") % 4
    text = F.when(k == 0, F.concat(n, F.lit(".5 %"))).when(k == 1, F.concat(F.lit("% "), n)).when(k == 2, F.concat(F.lit("- "), n)).otherwise(F.concat(n, F.lit("퍼센트")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.loose_percentage(text).alias("percentage"))


@query(
    "f25_initial_buckets",
    """SELECT bucket, kind, count(*) AS n FROM (SELECT CASE o_custkey % 6 WHEN 0 THEN 'subsidiaries' WHEN 1 THEN 'affiliates' WHEN 2 THEN 'affiliates' WHEN 3 THEN 'joint_ventures' ELSE 'special_relations' END AS bucket,
  CASE o_custkey % 6 WHEN 0 THEN '종속기업' WHEN 1 THEN '관계기업' WHEN 2 THEN '관계기업' WHEN 3 THEN '공동기업' WHEN 4 THEN '특수관계기업' ELSE 'unknown' END AS kind FROM orders) GROUP BY 1, 2""",
)
def initial_buckets(spark, d):
    """Companies by what texts say of their relationship, and the bucket that it puts them in."""
    k = F.col("o_custkey") % 6
    said = F.when(k == 0, "당사의 종속기업").when(k == 1, "관계기업 투자").when(k == 2, "an Affiliate of").when(k == 3, "공동지배 약정").when(k == 4, "특수관계기업").otherwise("기타 회사")
    rows = table(spark, d, "orders").select(T.relationship_type(said).alias("kind"))
    return rows.groupBy(T.initial_bucket("kind").alias("bucket"), "kind").agg(F.count(F.lit(1)).alias("n"))


# --- statements


@query(
    "h14_whole_metadata",
    f"""WITH {CELLS_SQL}, r AS (SELECT table_id, count(DISTINCT row_index) AS row_count, count(DISTINCT col_index) AS column_count, count(*) AS n, count(*) FILTER (WHERE col_index = 2 AND text = '-') AS dashes,
  count(*) FILTER (WHERE col_index = 3 OR (col_index = 2 AND text <> '-') OR (col_index = 1)) AS numbers, bool_or(col_index = 0 AND text LIKE '%R항목') AS is_financial FROM cells GROUP BY 1)
SELECT table_id, row_count, column_count, is_financial, round(numbers / n::DOUBLE, 6) AS numeric_ratio, numbers / n::DOUBLE > 0.3 AS require_unit FROM r""",
)
def whole_metadata(spark, d):
    """Size, share of numbers, financial words and the need of a unit of each table, over all of its columns."""
    c = cells(spark, d)
    # Labels have figures, but are texts here, as their numbers are no values.
    c = c.withColumn("text", F.when(F.col("col_index") == 0, F.regexp_replace("text", r"\d", "")).otherwise(F.col("text")))
    m = statement_tables.table_metadata(c, ("R항목",))
    return m.select("table_id", "row_count", "column_count", "is_financial", F.round("numeric_ratio", 6).alias("numeric_ratio"), "require_unit")


@query(
    "h21_unit_heirs",
    f"""WITH {CELLS_SQL}, s AS (SELECT table_id, row_index, col_index, CASE WHEN table_id % 3 = 0 THEN text WHEN col_index = 0 AND table_id % 3 = 1 THEN '합계 krw' ELSE 'words' END AS text FROM cells)
SELECT table_id, table_id % 3 = 0 OR (table_id % 3 = 1 AND min(row_index) < 5) AS inherits FROM s GROUP BY 1""",
)
def unit_heirs(spark, d):
    """Tables that take the unit before them: with numbers, with a currency near their top, and others that do not."""
    k = F.col("table_id") % 3
    text = F.when(k == 0, F.col("text")).when((F.col("col_index") == 0) & (k == 1), "합계 krw").otherwise("words")
    c = cells(spark, d).withColumns({"text": text, "column_name": F.when(k == 0, F.col("column_name")).otherwise("plain")})
    return statement_tables.inherits_unit(c, ("krw",), ("자산",))


@query("p2_sections_of_a_kind", f"WITH {NOTES_SQL} SELECT CASE WHEN contains(title, 'the') OR contains(title, 'ing') THEN 'english' WHEN contains(title, 'eau') OR contains(title, 'que') THEN 'french' ELSE 'other' END AS kind, note_number, count(*) AS n FROM notes GROUP BY 1, 2")
def sections_of_a_kind(spark, d):
    """Sections chosen by the words of their titles, the first kind that fits."""
    kind = F.when(T.any_of(F.col("title"), ("the", "ing")), "english").when(T.any_of(F.col("title"), ("eau", "que")), "french").otherwise("other")
    return made_notes(spark, d).groupBy(kind.alias("kind"), "note_number").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j2_contained_data",
    f"""WITH {STATEMENTS_SQL}, known AS (SELECT DISTINCT section_code, year FROM statements WHERE year % 2 = 1) SELECT sha1('company|' || lower(s.section_code) || '|' || s.year) AS src_id, sha1('company|' || s.year || '|' || lower(item_name) || '|' || lower(s.section_code)) AS dst_id, 'contains_data' AS rel_type
FROM statements s JOIN known k ON k.section_code = s.section_code AND k.year = s.year""",
)
def contained_data(spark, d):
    """Edges from year nodes to their data; data of years without a node have none."""
    facts = statements(spark, d).withColumn("company", F.lit("company"))
    years = facts.where("year % 2 = 1").select("company", "section_code", "year").distinct().withColumn("id", node_id("year_node"))
    data = facts.withColumn("id", node_id("financial_data", column_name="section_code"))
    tried = data.select(node_id("year_node").alias("src_id"), F.col("id").alias("dst_id"), F.lit("contains_data").alias("rel_type"))
    return upsert.existing_edges(tried, years.select("id"), data.select("id"))


ITEMS_SQL = f"""{STATEMENT_ROWS_SQL}, items AS (SELECT company, year, item_name, sum(amount) AS value, list(DISTINCT CAST(line_number AS INTEGER)) AS refs FROM statement_rows GROUP BY 1, 2, 3),
known AS (SELECT DISTINCT CAST(o_custkey % 100 AS BIGINT) AS company, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderkey % 7 AS INTEGER) AS note_number, 'note ' || o_orderkey % 7 AS title FROM orders)"""


def _items_with_notes(spark, d):
    refs = F.collect_set(F.col("line_number").cast("int"))
    items = statement_rows(spark, d).groupBy("company", "year", "item_name").agg(F.sum("amount").alias("value"), refs.alias("refs"))
    number = (F.col("o_orderkey") % 7).cast("int")
    known = table(spark, d, "orders").select((F.col("o_custkey") % 100).alias("company"), F.year("o_orderdate").alias("year"), number.alias("note_number"), F.concat(F.lit("note "), number.cast("string")).alias("title")).distinct()
    return notes.note_links(items, known.select("company", "year", "note_number"), "refs", ["company", "year"]), known


@query("q6_items_and_their_notes", f"WITH {ITEMS_SQL}, j AS (SELECT i.company, i.year, item_name, value, note_number, title FROM (SELECT *, unnest(refs) AS note_number FROM items) i JOIN known USING (company, year, note_number)) SELECT company, year, item_name, CAST(any_value(value) AS DOUBLE) AS value, string_agg(title, ',' ORDER BY note_number) AS titles, count(*) AS n FROM j GROUP BY 1, 2, 3 HAVING count(*) > 1")
def items_and_their_notes(spark, d):
    """Items with more than one note, with the titles of their notes."""
    links, known = _items_with_notes(spark, d)
    named = links.join(known, ["company", "year", "note_number"])
    g = named.groupBy("company", "year", "item_name").agg(F.first("value").cast("double").alias("value"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("note_number", "title"))), lambda x: x["title"]), ",").alias("titles"), F.count(F.lit(1)).alias("n"))
    return g.where("n > 1")


@query("j14_chosen_items_with_notes", f"WITH {ITEMS_SQL} SELECT i.company, i.year, item_name, count(*) AS n FROM (SELECT *, unnest(refs) AS note_number FROM items WHERE item_name LIKE 'P%' AND value > 10000) i JOIN known USING (company, year, note_number) GROUP BY 1, 2, 3")
def chosen_items_with_notes(spark, d):
    """Items that a predicate chooses, where they have any note at all."""
    links, _ = _items_with_notes(spark, d)
    return links.where("item_name like 'P%' and value > 10000").groupBy("company", "year", "item_name").agg(F.count(F.lit(1)).alias("n"))


# --- drawings and bundles


@query(
    "d18_labelled_nodes",
    f"""WITH {STATEMENTS_SQL}, r AS (SELECT section_code AS company, item_name, year, CASE WHEN year % 2 = 0 THEN 'current' END AS period, value FROM statements)
SELECT DISTINCT 'company:' || company AS id, company AS label FROM r UNION SELECT 'item:' || item_name, item_name FROM r UNION SELECT 'year:' || year, 'Y:' || year FROM r UNION SELECT 'period:' || period, 'P:' || period FROM r WHERE period IS NOT NULL
UNION SELECT 'value:' || company || ':' || item_name || ':' || year, 'V:' || value FROM r""",
)
def labelled_nodes(spark, d):
    """The nodes of a drawing of statement records."""
    return graph.graph_elements(_records(spark, d))[0]


@query(
    "d18_labelled_edges",
    f"""WITH {STATEMENTS_SQL}, r AS (SELECT section_code AS company, item_name, year, CASE WHEN year % 2 = 0 THEN 'current' END AS period, value FROM statements)
SELECT DISTINCT 'company:' || company AS source, 'item:' || item_name AS target, 'has_data' AS label FROM r UNION SELECT 'item:' || item_name, 'year:' || year, 'in_year' FROM r UNION SELECT 'year:' || year, 'period:' || period, 'period' FROM r WHERE period IS NOT NULL
UNION SELECT 'item:' || item_name, 'value:' || company || ':' || item_name || ':' || year, 'value' FROM r""",
)
def labelled_edges(spark, d):
    """The labelled edges of the same drawing."""
    return graph.graph_elements(_records(spark, d))[1]


def _records(spark, d):
    return statements(spark, d).select(F.col("section_code").alias("company"), "item_name", "year", F.when(F.col("year") % 2 == 0, "current").alias("period"), "value")


@query(
    "q24_summary_bundle",
    f"""WITH {STATEMENTS_SQL}, {CATEGORIES_SQL}, {NOTES_SQL} SELECT 'sections' AS part, section_code AS a, NULL AS b, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total, min(year) AS first_year, max(year) AS last_year FROM statements GROUP BY 2
UNION ALL SELECT 'levels', CAST(level AS VARCHAR), NULL, count(*), NULL, NULL, NULL FROM categories GROUP BY 2 UNION ALL SELECT 'years', CAST(year AS VARCHAR), section_code, count(*), CAST(sum(value) AS DOUBLE), NULL, NULL FROM statements GROUP BY 2, 3
UNION ALL SELECT 'notes', CAST(note_number AS VARCHAR), NULL, count(*), NULL, min(year), max(year) FROM notes GROUP BY 2 UNION ALL SELECT 'covered', NULL, NULL, count(DISTINCT year), NULL, min(year), max(year) FROM statements""",
)
def summary_bundle(spark, d):
    """All parts of the overview in one table: sections, levels, years by section, notes by number, and the years covered."""
    s, c, n = statements(spark, d).withColumn("v", F.col("value").cast("decimal(28,2)")), categories(spark, d), made_notes(spark, d)
    total = F.sum("v").cast("double").alias("total")
    parts = [
        s.groupBy(F.col("section_code").alias("a")).agg(F.lit("sections").alias("part"), F.count(F.lit(1)).alias("n"), total, F.min("year").alias("first_year"), F.max("year").alias("last_year")),
        c.groupBy(F.col("level").cast("string").alias("a")).agg(F.lit("levels").alias("part"), F.count(F.lit(1)).alias("n")),
        s.groupBy(F.col("year").cast("string").alias("a"), F.col("section_code").alias("b")).agg(F.lit("years").alias("part"), F.count(F.lit(1)).alias("n"), total),
        n.groupBy(F.col("note_number").cast("string").alias("a")).agg(F.lit("notes").alias("part"), F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year")),
        s.agg(F.lit("covered").alias("part"), F.count_distinct("year").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year")),
    ]
    every = reduce(lambda a, b: DataFrame.unionByName(a, b, allowMissingColumns=True), parts)
    return every.select("part", "a", "b", "n", "total", "first_year", "last_year")


@query("q25_level_listing", f"WITH {CATEGORIES_SQL} SELECT level, parent_path, count(*) AS n, min(name) AS first_name FROM categories WHERE level IN (1, 2, 3) GROUP BY 1, 2")
def level_listing(spark, d):
    """Categories of some levels below each parent."""
    return categories(spark, d).where("level in (1, 2, 3)").groupBy("level", "parent_path").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first_name"))


@query("q25_item_search", f"WITH {STATEMENTS_SQL} SELECT item_name, year, section_code, value FROM statements WHERE contains(item_name, 'M') AND year = 1998")
def item_search(spark, d):
    """Items whose name has a word, in a year."""
    return statements(spark, d).where(F.col("item_name").contains("M") & (F.col("year") == 1998)).select("item_name", "year", "section_code", "value")


@query("q26_partners_by_name", f"WITH {EDGES_SQL} SELECT c_name AS name, c_mktsegment AS segment, count(DISTINCT src_id) AS companies, count(DISTINCT rel_type) AS kinds FROM edges JOIN customer ON dst_id = c_custkey WHERE contains(c_name, '7') GROUP BY 1, 2")
def partners_by_name(spark, d):
    """Partners whose name has a word, with how many companies and in what ways they are related."""
    c = table(spark, d, "customer").where(F.col("c_name").contains("7"))
    e = company_edges(spark, d).join(c, F.col("dst_id") == F.col("c_custkey"))
    return e.groupBy(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).agg(F.count_distinct("src_id").alias("companies"), F.count_distinct("rel_type").alias("kinds"))


@query("q26_companies", f"WITH {EDGES_SQL} SELECT s_name AS name, n_name AS nation, count(*) AS postings, min(year) AS first_year, max(year) AS last_year FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN edges ON src_id = s_suppkey GROUP BY 1, 2")
def companies_of_the_store(spark, d):
    """All companies with what there is of them."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    e = company_edges(spark, d).groupBy("src_id").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    j = s.join(e, F.col("s_suppkey") == F.col("src_id"), "left")
    return j.select(F.col("s_name").alias("name"), F.col("n_name").alias("nation"), F.coalesce("n", F.lit(1)).alias("postings"), "first_year", "last_year")


@query("q29_edges_with_types", f"WITH {EDGES_SQL} SELECT src_id, dst_id, string_agg(DISTINCT rel_type, ',' ORDER BY rel_type) AS kinds, count(DISTINCT rel_type) AS n FROM edges GROUP BY 1, 2 HAVING count(DISTINCT rel_type) > 1")
def edges_with_types(spark, d):
    """Pairs that are related in more than one way, with all of them."""
    g = company_edges(spark, d).groupBy("src_id", "dst_id").agg(F.array_sort(F.collect_set("rel_type")).alias("k"))
    return g.where(F.size("k") > 1).select("src_id", "dst_id", F.array_join("k", ",").alias("kinds"), F.size("k").cast("long").alias("n"))


@query(
    "q17_properties",
    """SELECT 'supplier' AS label, unnest(['s_suppkey', 's_name', 's_nationkey']) AS property, unnest(['bigint', 'string', 'int']) AS type, unnest([count(s_suppkey), count(s_name), count(s_nationkey)]) AS filled,
  unnest([min(CAST(s_suppkey AS VARCHAR)), min(s_name), min(CAST(s_nationkey AS VARCHAR))]) AS smallest, unnest([max(CAST(s_suppkey AS VARCHAR)), max(s_name), max(CAST(s_nationkey AS VARCHAR))]) AS largest FROM supplier
UNION ALL SELECT 'nation', unnest(['n_nationkey', 'n_name']), unnest(['int', 'string']), unnest([count(n_nationkey), count(n_name)]), unnest([min(CAST(n_nationkey AS VARCHAR)), min(n_name)]), unnest([max(CAST(n_nationkey AS VARCHAR)), max(n_name)]) FROM nation""",
)
def properties(spark, d):
    """The columns of node tables, with their types, how many are filled, and values at both ends."""
    return graph.sampled_properties({"supplier": table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "nation": table(spark, d, "nation").select("n_nationkey", "n_name")})


@query("f34_limited_rows", "SELECT o_orderkey, o_orderpriority FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r <= CASE o_orderpriority WHEN '1-URGENT' THEN 200 WHEN '2-HIGH' THEN 20 ELSE 50 END")
def limited_rows(spark, d):
    """The last rows of each kind, as many as it is allowed."""
    return graph.limited(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", [F.desc("o_orderkey")], {"1-URGENT": 200, "2-HIGH": 20})


@query(
    "d7_ownership_graph",
    """WITH r AS (SELECT 'p' || l_partkey % 700 AS name, CASE WHEN l_suppkey % 5 > 0 THEN CAST(l_suppkey % 90 AS DOUBLE) END AS percent, CASE l_suppkey % 4 WHEN 0 THEN '종속기업' WHEN 1 THEN '관계기업' WHEN 2 THEN '공동기업' ELSE 'x' END AS kind, l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
f AS (SELECT name, min(struct_pack(s := seq, a := percent IS NOT NULL, p := percent, k := kind)) AS r FROM r GROUP BY 1), c AS (
SELECT name, r.p AS percent, CASE WHEN r.p >= 50 THEN 'SUBSIDIARY' WHEN r.p >= 20 THEN 'AFFILIATE' WHEN r.p IS NOT NULL THEN CASE WHEN r.k = '공동기업' THEN 'JOINT_VENTURE' ELSE 'SPECIAL_RELATION' END
  WHEN r.k = '종속기업' THEN 'SUBSIDIARY' WHEN r.k = '관계기업' THEN 'AFFILIATE' WHEN r.k = '공동기업' THEN 'JOINT_VENTURE' ELSE 'SPECIAL_RELATION' END AS type FROM f)
SELECT sha1('owner') AS src_id, sha1('owner|' || lower(type) || '|' || name) AS dst_id, 'has_' || lower(type) AS rel_type, percent AS ownership_percentage, name, type AS company_type FROM c""",
)
def ownership_graph(spark, d):
    """Companies first seen with a share or a kind, by class, with the typed edge of each."""
    k = F.col("l_suppkey")
    kind = F.when(k % 4 == 0, "종속기업").when(k % 4 == 1, "관계기업").when(k % 4 == 2, "공동기업").otherwise("x")
    rows = table(spark, d, "lineitem").select(F.concat(F.lit("p"), (F.col("l_partkey") % 700).cast("string")).alias("name"), F.when(k % 5 > 0, (k % 90).cast("double")).alias("percent"), kind.alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    nodes, edges = relations.company_graph(relations.companies(rows, "name", "percent", "kind", "seq"), "owner", "name")
    return edges.join(nodes.select(F.col("id").alias("dst_id"), "name", "company_type"), "dst_id").select("src_id", "dst_id", "rel_type", "ownership_percentage", "name", "company_type")
