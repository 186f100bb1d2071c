"""Further operators over the driver's tables: predicates, joins, tables, checks."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.functions.ids import node_id
from brightledger.operators import graph, reports, search, statement_tables, upsert
from brightledger.plans.registry import query
from brightledger.sources.tables import CELLS_SQL, EDGES_SQL, NOTES_SQL, STATEMENT_ROWS_SQL, STATEMENTS_SQL, cells, company_edges, notes, statement_rows, table

KINDS = "CASE o_orderkey % 4 WHEN 0 THEN '종속기업 A' WHEN 1 THEN 'affiliate B' WHEN 2 THEN '공동지배 C' ELSE 'D' END"


def _kind_text():
    k = F.col("o_orderkey") % 4
    return F.when(k == 0, "종속기업 A").when(k == 1, "affiliate B").when(k == 2, "공동지배 C").otherwise("D")


@query("f24_ownership_texts", "SELECT o_orderkey, CASE WHEN o_custkey % 130 <= 100 THEN CAST(o_custkey % 130 AS DOUBLE) END AS percentage FROM orders")
def ownership_texts(spark, d):
    """Ownership percentages read from text."""
    t = F.concat(F.lit("지분 "), (F.col("o_custkey") % 130).cast("string"), F.lit(" % 보유"))
    return table(spark, d, "orders").select("o_orderkey", T.ownership_percentage(t).alias("percentage"))


@query("f25_relationship_types", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '종속기업' WHEN 1 THEN '관계기업' WHEN 2 THEN '공동기업' ELSE 'unknown' END AS relationship FROM orders")
def relationship_types(spark, d):
    """Kinds of relationship read from text."""
    return table(spark, d, "orders").select("o_orderkey", T.relationship_type(_kind_text()).alias("relationship"))


@query("f9_statement_types", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'BS' WHEN 1 THEN 'PL' ELSE 'OTHER' END AS code FROM orders")
def statement_types(spark, d):
    """Statements recognised by name."""
    k = F.col("o_orderkey") % 3
    name = F.when(k == 0, "연결 재무상태표").when(k == 1, "Income statement").otherwise("x")
    return table(spark, d, "orders").select("o_orderkey", T.statement_type(name, english=True).alias("code"))


@query("f4_section_text", "SELECT o_orderkey, 'a ' || CAST(o_custkey AS VARCHAR) || ' b' AS clean FROM orders")
def section_texts(spark, d):
    """Section text without empty lines."""
    t = F.concat(F.lit(" a \n\n "), F.col("o_custkey").cast("string"), F.lit("\n\n\n b "))
    return table(spark, d, "orders").select("o_orderkey", T.section_text(t).alias("clean"))


@query("f14_note_strings", "SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS strings FROM orders")
def note_strings(spark, d):
    """Arrays of strings without blanks, null if none is left."""
    a = F.array(F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"))), F.lit(" "), F.lit(None).cast("string"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(T.note_strings(a), ",").alias("strings"))


@query("f16_disambiguated_keys", f"WITH {CELLS_SQL}, c AS (SELECT DISTINCT table_id, col_index FROM cells) SELECT table_id, col_index, 'key' || CASE WHEN col_index > 0 THEN '_' || CAST(col_index + 1 AS VARCHAR) ELSE '' END AS key FROM c")
def disambiguated_keys(spark, d):
    """Equal keys of a table told apart: key, key_2, key_3."""
    c = cells(spark, d).select("table_id", "col_index").distinct()
    n = F.row_number().over(W.partitionBy("table_id").orderBy("col_index"))
    return c.withColumn("n", n).select("table_id", "col_index", F.when(F.col("n") > 1, F.concat(F.lit("key_"), F.col("n").cast("string"))).otherwise("key").alias("key"))


@query("f18_loose_amounts", f"WITH {CELLS_SQL} SELECT table_id, row_index, text, TRY_CAST(regexp_replace(text, '[, ]', '', 'g') AS DOUBLE) AS amount, coalesce(TRY_CAST(regexp_replace(text, '[, ]', '', 'g') AS DOUBLE) IS NOT NULL AND length(regexp_replace(text, '[, ]', '', 'g')) >= 3, false) AS is_amount FROM cells WHERE col_index = 2")
def loose_amounts(spark, d):
    """Amounts by the looser reading."""
    return cells(spark, d).where("col_index = 2").select("table_id", "row_index", "text", T.loose_amount("text").alias("amount"), T.is_amount("text").alias("is_amount"))


@query("f37_item_buckets", "SELECT bucket, count(*) AS n FROM (SELECT unnest(CASE o_orderkey % 4 WHEN 0 THEN ['revenue'] WHEN 1 THEN ['liabilities'] WHEN 2 THEN ['assets', 'equity', 'profit'] ELSE ['profit'] END) AS bucket FROM orders) GROUP BY 1")
def item_buckets(spark, d):
    """Labels by bucket; a label may be in several."""
    k = F.col("o_orderkey") % 4
    label = F.when(k == 0, "매출액").when(k == 1, "유동부채").when(k == 2, "자산과 자본 및 이익").otherwise("손익")
    return table(spark, d, "orders").select(F.explode(T.item_buckets(label)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("h4_continued_markers", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'text' END AS text FROM orders")
def continued_markers(spark, d):
    """Texts without markers of continuation."""
    t = F.when(F.col("o_orderkey") % 2 == 0, "text , 계속").otherwise(" , 계속 ")
    return table(spark, d, "orders").select("o_orderkey", T.without_continued(t, [r",\s*계속"]).alias("text"))


@query("h12_filled_cells", f"WITH {CELLS_SQL}, b AS (SELECT table_id, row_index, col_index, CASE WHEN row_index = 2 OR col_index = 1 THEN ' ' ELSE text END AS text FROM cells) SELECT table_id, count(*) AS n FROM b WHERE row_index <> 2 AND col_index <> 1 GROUP BY 1")
def filled_cells(spark, d):
    """Cells of rows and columns that hold text."""
    blank = cells(spark, d).withColumn("text", F.when((F.col("row_index") == 2) | (F.col("col_index") == 1), " ").otherwise(F.col("text")))
    return statement_tables.without_empty(blank).groupBy("table_id").agg(F.count(F.lit(1)).alias("n"))


@query("h17_table_units", f"WITH {CELLS_SQL} SELECT DISTINCT table_id, CASE WHEN table_id % 2 = 0 AND table_id IN (SELECT table_id FROM cells WHERE row_index = 1) THEN '천원' END AS unit FROM cells")
def table_units(spark, d):
    """Units of tables by their first row."""
    c = cells(spark, d).withColumn("row_index", F.col("row_index") - 1)
    marked = c.withColumn("text", F.when((F.col("row_index") == 0) & (F.col("col_index") == 0) & (F.col("table_id") % 2 == 0), "(단위 : 천원)").otherwise(F.col("text")))
    return statement_tables.table_units(marked)


@query("h19_row_units", f"WITH {CELLS_SQL} SELECT DISTINCT table_id, row_index, '%' AS unit FROM cells WHERE row_index % 3 = 0")
def row_units(spark, d):
    """Units given in a row of their own."""
    marked = cells(spark, d).withColumn("text", F.when((F.col("row_index") % 3 == 0) & (F.col("col_index") >= 2), "(단위: %)").otherwise(F.col("text")))
    return statement_tables.row_units(marked)


@query("h22_note_references", f"WITH {CELLS_SQL} SELECT table_id, bool_or(col_index = 1) AS has_references FROM cells WHERE col_index IN (0, 1) GROUP BY 1")
def note_references(spark, d):
    """Tables with note references."""
    c = cells(spark, d).where("col_index in (0, 1)")
    return c.groupBy("table_id").agg(F.bool_or(T.note_reference("text").isNotNull()).alias("has_references"))


@query("h23_table_summary", f"WITH {CELLS_SQL}, m AS (SELECT table_id, count(DISTINCT row_index) AS r, count(DISTINCT col_index) AS c FROM cells GROUP BY 1) SELECT 'valid' AS status, count(*) AS tables, CAST(sum(r) AS BIGINT) AS rows, round(avg(c), 6) AS avg_columns, -(max({{'r': r, 't': -table_id}})).t AS largest FROM m")
def table_summary(spark, d):
    """All tables in one line: totals, averages, the largest."""
    return statement_tables.table_summary(statement_tables.table_metadata(cells(spark, d), ("자산",)))


@query("p1_indexed_rows", "SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'BS' WHEN 2 THEN 'PL' WHEN 4 THEN 'CF' END AS code FROM lineitem WHERE l_linenumber IN (1, 2, 4)")
def indexed_rows(spark, d):
    """Rows of the tables that an index names, with their statement."""
    index = spark.createDataFrame([(1, "BS"), (2, "PL"), (4, "CF")], "l_linenumber int, code string")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(F.broadcast(index), "l_linenumber")


@query("p3_long_enough", "SELECT lang, count(*) AS n FROM documents WHERE length(trim(text)) >= 200 GROUP BY 1")
def long_enough(spark, d):
    """Texts of some length, by language."""
    return table(spark, d, "documents").where(F.length(F.trim("text")) >= 200).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("j1_category_data", "SELECT n_name, c_mktsegment, count(*) AS n, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def category_data(spark, d):
    """Data by category, over two edges."""
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("total"))


@query("j2_year_data_edges", f"WITH {STATEMENT_ROWS_SQL} SELECT DISTINCT sha1('c|' || lower(section_code) || '|' || CAST(year AS VARCHAR)) AS src_id, item_name FROM statement_rows")
def year_data_edges(spark, d):
    """Edges from year nodes to the items that they hold."""
    r = statement_rows(spark, d).select("section_code", "year", "item_name").distinct()
    return r.select(node_id("year_node", company=F.lit("c")).alias("src_id"), "item_name").distinct()


@query("j3_unmatched_paths", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1")
def unmatched_paths(spark, d):
    """Rows whose category is missing: what an edge build must report."""
    c = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(c, "o_custkey", "left_anti").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("j12_optional_kinds", f"WITH {EDGES_SQL} SELECT s_suppkey, count(*) FILTER (WHERE rel_type = 'owes') AS owes, count(*) FILTER (WHERE rel_type = 'trades') AS trades FROM supplier LEFT JOIN edges ON src_id = s_suppkey AND year = 2001 GROUP BY 1")
def optional_kinds(spark, d):
    """Relations of each company by kind in a year, none as zero."""
    e = company_edges(spark, d).where("year = 2001").groupBy(F.col("src_id").alias("s_suppkey"))
    counted = e.agg(F.count_if(F.col("rel_type") == "owes").alias("owes"), F.count_if(F.col("rel_type") == "trades").alias("trades"))
    return table(spark, d, "supplier").select("s_suppkey").join(counted, "s_suppkey", "left").na.fill(0, ["owes", "trades"])


@query("j15_any_edges", f"WITH {EDGES_SQL} SELECT s_name, c_name, rel_type FROM edges JOIN supplier ON src_id = s_suppkey JOIN customer ON dst_id = c_custkey")
def any_edges(spark, d):
    """Edges of any type with the names of both ends."""
    e = company_edges(spark, d)
    s, c = table(spark, d, "supplier"), table(spark, d, "customer")
    return e.join(s, e.src_id == s.s_suppkey).join(c, e.dst_id == c.c_custkey).select("s_name", "c_name", "rel_type")


@query("a12_audit_dedupe", "SELECT o_orderpriority AS audit_type, CAST(year(o_orderdate) AS INTEGER) AS year, (min({'s': o_orderkey, 'v': o_orderstatus}) FILTER (WHERE o_orderstatus <> 'P')).v AS opinion, min(o_orderkey) AS first FROM orders GROUP BY 1, 2")
def audit_dedupe(spark, d):
    """One audit row per type and year: the first value of each field."""
    o = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("audit_type"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("opinion"), F.col("o_orderkey").alias("first"),
    )
    return upsert.first_filled(o, ["audit_type", "year"], ["opinion", "first"])


@query("a16_link_statistics", f"WITH {CELLS_SQL} SELECT row_index AS section, count(*) AS links, count(DISTINCT n) AS notes FROM (SELECT row_index, unnest(string_split(text, ', ')) AS n FROM cells WHERE col_index = 1) GROUP BY 1")
def link_statistics(spark, d):
    """Note links by section."""
    links = cells(spark, d).where("col_index = 1").select(F.col("row_index").alias("section"), F.explode(T.note_reference("text")).alias("note"))
    return statement_tables.note_link_statistics(links, "section", "note")


@query("a16_most_linked_notes", f"WITH {CELLS_SQL} SELECT CAST(n AS INTEGER) AS note, count(*) AS links FROM (SELECT unnest(string_split(text, ', ')) AS n FROM cells WHERE col_index = 1) GROUP BY 1 ORDER BY links DESC, note LIMIT 5")
def most_linked_notes(spark, d):
    """The five notes that most rows refer to."""
    links = cells(spark, d).where("col_index = 1").select(F.explode(T.note_reference("text")).alias("note"))
    return statement_tables.most_linked(links, "note")


@query("a16_most_linking_rows", f"WITH {CELLS_SQL}, l AS (SELECT table_id, row_index, unnest(string_split(text, ', ')) AS n FROM cells WHERE col_index = 1) SELECT c.text AS category, count(*) AS links FROM l JOIN cells c ON l.table_id = c.table_id AND l.row_index = c.row_index AND c.col_index = 0 GROUP BY 1 ORDER BY links DESC, category LIMIT 5")
def most_linking_rows(spark, d):
    """The five categories that refer to most notes."""
    c = cells(spark, d)
    links = c.where("col_index = 1").select("table_id", "row_index", F.explode(T.note_reference("text")).alias("note"))
    names = c.where("col_index = 0").select("table_id", "row_index", F.col("text").alias("category"))
    return statement_tables.most_linked(links.join(names, ["table_id", "row_index"]), "category")


@query("a22_edge_sums", f"WITH {EDGES_SQL} SELECT src_id, CAST(sum(CASE WHEN rel_type = 'owes' THEN amount ELSE 0 END) AS DOUBLE) AS debt, count(*) FILTER (WHERE rel_type = 'invests' OR year = 1995) AS relevant FROM edges GROUP BY 1")
def edge_sums(spark, d):
    """Sums and counts over edge properties under conditions."""
    debt = F.sum(F.when(F.col("rel_type") == "owes", F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double")
    return company_edges(spark, d).groupBy("src_id").agg(debt.alias("debt"), F.count_if((F.col("rel_type") == "invests") | (F.col("year") == 1995)).alias("relevant"))


@query("u4_all_documents", f"WITH {NOTES_SQL} SELECT 'note' AS kind, count(*) AS n FROM notes UNION ALL SELECT 'page', count(*) FROM pages UNION ALL SELECT 'item', count(*) FROM benchmark")
def all_documents(spark, d):
    """Documents of several kinds in one table, by kind."""
    parts = [notes(spark, d).select(F.lit("note").alias("kind"), "content"), table(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("html").alias("page_html")), table(spark, d, "benchmark").select(F.lit("item").alias("kind"), F.col("text").alias("content"))]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("u5_index_difference", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def index_difference(spark, d):
    """Orders in one set and not in another."""
    l = table(spark, d, "lineitem")
    return l.where("l_returnflag = 'A'").select("l_orderkey").distinct().join(l.where("l_returnflag = 'R'").select("l_orderkey"), "l_orderkey", "left_anti")


@query("d6_companies_from_cells", f"WITH {CELLS_SQL} SELECT DISTINCT table_id, row_index, 'company ' || CAST(row_index AS VARCHAR) AS company, CAST(row_index AS VARCHAR) || ' %' AS percent FROM cells")
def companies_from_cells(spark, d):
    """Companies and percentages in rows of cells."""
    from brightledger.operators.relations import company_rows_from_cells

    c = cells(spark, d)
    column = F.when(F.col("col_index") == 0, "회사명").otherwise(F.col("column_name"))
    text = F.when(F.col("col_index") == 0, F.concat(F.lit("company "), F.col("row_index").cast("string"))).when(F.col("col_index") == 1, F.concat(F.col("row_index").cast("string"), F.lit(" %"))).otherwise(F.col("text"))
    rows = c.select("table_id", "row_index", "col_index", column.alias("column_name"), text.alias("text"))
    return company_rows_from_cells(rows, ["table_id", "row_index"], "column_name", "text", "col_index").select("table_id", "row_index", "company", "percent")


@query("d8_section_documents")
def section_documents(spark, d):
    """Search documents of page sections."""
    heading = F.col("tag").isin("h1", "h2", "h3")
    s = reports.section_contents(reports.sections(reports.blocks(table(spark, d, "pages")), heading), heading)
    s = s.withColumns({"anchor": F.concat_ws("-", F.col("page_id").cast("string"), F.col("section_index").cast("string")), "year": F.lit(None).cast("int")})
    return search.documents(s, "section", "title", "content", "anchor", "year", 50)


@query("d9_note_documents", f"WITH {NOTES_SQL} SELECT company, year, note_number, count(*) AS fragments, sha256(string_agg(concat_ws(': ', title, content), chr(10) ORDER BY seq, concat_ws(': ', title, content))) AS text_sha256 FROM notes WHERE length(trim(content)) >= 50 GROUP BY 1, 2, 3")
def note_documents(spark, d):
    """Note fragments combined into one document per number: a digest of the text, and how many fragments it has."""
    n = notes(spark, d).where(F.length(F.trim("content")) >= 50)
    parts = F.array_sort(F.collect_list(F.struct("seq", F.concat_ws(": ", "title", "content").alias("c"))))
    g = n.groupBy("company", "year", "note_number").agg(parts.alias("p"), F.count(F.lit(1)).alias("fragments"))
    return g.select("company", "year", "note_number", "fragments", F.sha2(F.array_join(F.transform("p", lambda x: x["c"]), "\n"), 256).alias("text_sha256"))


@query("v3_integrity", f"WITH {EDGES_SQL} SELECT 'missing_partner' AS category, count(*) AS n FROM edges WHERE dst_id NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'unused_customer', count(*) FROM customer WHERE c_custkey NOT IN (SELECT dst_id FROM edges)")
def integrity(spark, d):
    """Dangling edges and unused nodes, as counts."""
    e = company_edges(spark, d)
    n = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    a = upsert.dangling_edges(e, n, "dst_id").agg(F.lit("missing_partner").alias("category"), F.count(F.lit(1)).alias("n"))
    return a.unionByName(graph.orphans(n, e.select(F.col("dst_id").alias("src_id"), "dst_id")).agg(F.lit("unused_customer").alias("category"), F.count(F.lit(1)).alias("n")))


@query("v7_numbering_order", "SELECT o_custkey, o_orderkey, n, p AS previous_number FROM (SELECT o_custkey, o_orderkey, o_orderkey % 10 AS n, lag(o_orderkey % 10) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) WHERE p > n")
def numbering_order(spark, d):
    """Sections numbered out of order."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 10).alias("n"))
    return statement_tables.out_of_order(o, "o_custkey", "o_orderkey", "n")


@query("v8_table_issues", f"WITH {CELLS_SQL}, b AS (SELECT table_id, count(*) AS n, count(*) FILTER (WHERE row_index > 1) AS empty FROM cells GROUP BY 1) SELECT table_id, CASE WHEN empty > 0.5 * n THEN 'mostly_empty' ELSE 'valid' END AS status FROM b")
def table_issues(spark, d):
    """Tables that are mostly empty."""
    c = cells(spark, d).withColumn("text", F.when(F.col("row_index") > 1, " ").otherwise(F.col("text")))
    return statement_tables.table_metadata(c, ("자산",)).select("table_id", "status")


@query("v10_year_mismatch", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS report_year, CAST(1995 + o_orderkey % 7 AS INTEGER) AS file_year FROM orders WHERE year(o_orderdate) <> 1995 + o_orderkey % 7")
def year_mismatch(spark, d):
    """Reports whose file name has another year."""
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("report_year"), F.concat(F.lit("r_"), (1995 + F.col("o_orderkey") % 7).cast("string")).alias("file"))
    return o.withColumn("file_year", F.regexp_extract("file", r"(\d{4})", 1).try_cast("int")).where("report_year <> file_year").drop("file")


@query("d16_load_counts", f"WITH {STATEMENT_ROWS_SQL}, s AS (SELECT DISTINCT item_name, section_code, year FROM statement_rows) SELECT 'data' AS \"table\", count(*) AS n FROM s UNION ALL SELECT 'years', count(*) FROM (SELECT DISTINCT section_code, year FROM s) UNION ALL SELECT 'sections', count(DISTINCT section_code) FROM s")
def load_counts(spark, d):
    """Sizes of the node tables that the whole load makes."""
    from brightledger.plans.statement_pipeline import build
    from brightledger.sources.scratch import written
    from brightledger.sources.tables import statements

    made = build(written(statements(spark, d)))
    frames = [made[t].agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("n")) for t in ("data", "years", "sections")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "j18_structural_edges",
    f"""WITH {STATEMENTS_SQL}, {NOTES_SQL}, k AS (SELECT DISTINCT company, year, note_number FROM notes WHERE length(trim(content)) >= 20), p AS (
  SELECT year, sha1('company|' || lower(section_code)) AS section, sha1('company|' || lower(section_code) || '|' || lower(replace(item_name, ' ', '>'))) AS category,
    sha1('company|' || CAST(year AS VARCHAR) || '|' || lower(item_name) || '|' || lower(section_code)) AS datum FROM statements)
SELECT DISTINCT sha1('company') AS src_id, section AS dst_id, 'has_financial_statement' AS rel_type FROM p UNION ALL SELECT DISTINCT section, category, 'has_category' FROM p
UNION ALL SELECT category, datum, 'related_to' FROM p UNION ALL SELECT sha1(lower(company)), sha1(lower(company) || '|' || CAST(year AS VARCHAR) || '|' || CAST(note_number AS VARCHAR)), 'has_note' FROM k""",
)
def structural_edges(spark, d):
    """Edges of the whole load from companies to statements and notes, and down to categories and their data."""
    from brightledger.plans.statement_pipeline import NOTE_CATEGORIES, NOTE_SUBCATEGORIES, load_tables
    from brightledger.sources.tables import statements

    made = load_tables(spark, d, statements(spark, d), None, NOTE_CATEGORIES, NOTE_SUBCATEGORIES)
    edges = made["edges"].unionByName(made["category_edges"]).unionByName(made["note_edges"])
    return edges.where(F.col("rel_type").isin("has_financial_statement", "has_category", "related_to", "has_note"))


@query(
    "d5_all_relations",
    f"""WITH b AS (SELECT l_suppkey AS p, o_custkey AS c, CAST(l_quantity AS DOUBLE) AS a, l_orderkey * 10 + l_linenumber AS seq, l_linenumber AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT p AS src_id, c AS dst_id, 'trades_with' AS rel_type, 'sales' AS transaction_type, a AS amount FROM b WHERE line % 2 = 0 UNION ALL SELECT c, p, 'trades_with', 'purchase', a FROM b WHERE line % 2 = 1
  UNION ALL SELECT c, p, 'owes_to', 'receivable', a FROM b WHERE line = 3)
SELECT src_id, dst_id, rel_type, transaction_type, max(amount) AS amount FROM r GROUP BY 1, 2, 3, 4""",
)
def all_relations(spark, d):
    """Relations of all kinds, merged by pair and kind."""
    from brightledger.operators import relations
    from brightledger.plans.relation_queries import base

    rows = base(spark, d)
    odd = F.col("line") % 2 == 1
    trades = relations.trade_relations(rows.withColumns({"s": F.when(~odd, F.col("a")), "b": F.when(odd, F.col("a"))}), "parent", "company", "s", "b")
    debts = relations.debt_relations(rows.withColumns({"r": F.when(F.col("line") == 3, F.col("a")), "q": F.lit(0.0)}), "parent", "company", "r", "q")
    return relations.all_relations([trades, debts]).select("src_id", "dst_id", "rel_type", "transaction_type", "amount")


@query("d7_company_graph", "SELECT 'has_' || CASE WHEN s_suppkey % 100 >= 50 THEN 'subsidiary' WHEN s_suppkey % 100 >= 20 THEN 'affiliate' ELSE 'special_relation' END AS rel_type, count(*) AS n FROM supplier GROUP BY 1")
def company_graph(spark, d):
    """Company nodes and typed ownership edges, by type."""
    from brightledger.operators import relations

    s = table(spark, d, "supplier").select(F.col("s_name").alias("name"), (F.col("s_suppkey") % 100).cast("double").alias("p"), F.lit("x").alias("k"), F.col("s_suppkey").alias("seq"))
    _, edges = relations.company_graph(relations.companies(s, "name", "p", "k", "seq"), "parent", "name")
    return edges.groupBy("rel_type").agg(F.count(F.lit(1)).alias("n"))


@query("d13_note_nodes", f"WITH {NOTES_SQL}, k AS (SELECT DISTINCT company, year, note_number FROM notes WHERE length(trim(content)) >= 20) SELECT sha1(lower(company) || '|' || CAST(year AS VARCHAR) || '|' || CAST(note_number AS VARCHAR)) AS id, year, note_number FROM k")
def note_nodes(spark, d):
    """Note nodes of merged notes, with their ids."""
    from brightledger.operators import notes as N

    merged = N.merge_notes(notes(spark, d), ["company", "year"], "note_number", "seq", "content")
    return merged.select(node_id("note").alias("id"), "year", "note_number")


@query("d12_audit_nodes", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CASE o_orderkey % 2 WHEN 0 THEN '한정의견' ELSE '적정의견' END AS opinion, count(*) AS n FROM orders GROUP BY 1, 2")
def audit_nodes(spark, d):
    """Audit sections by year and opinion."""
    t = F.concat_ws(" ", F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 2 == 0, "한정의견").otherwise("감사의견"))
    o = table(spark, d, "orders").select(t.alias("content"))
    g = o.groupBy(F.substring(T.iso_date("content"), 1, 4).cast("int").alias("year"), T.audit_opinion("content").alias("opinion"))
    return g.agg(F.count(F.lit(1)).alias("n"))


@query("h21_inherits_unit", f"WITH {CELLS_SQL} SELECT DISTINCT table_id, true AS inherits FROM cells")
def inherits_unit(spark, d):
    """Tables that should take the unit before them."""
    return statement_tables.inherits_unit(cells(spark, d), ("기", "krw"), ("자산",))


@query("a21_extraction_statistics", "SELECT o_orderpriority AS title, count(*) AS tables, count(*) FILTER (WHERE o_orderstatus = 'F') AS financial_tables, CAST(sum(o_custkey % 3) AS BIGINT) AS \"references\", count(DISTINCT o_orderstatus) AS codes FROM orders GROUP BY 1")
def extraction_statistics(spark, d):
    """What was found under each section title."""
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("title"), (F.col("o_orderstatus") == "F").alias("is_financial"), (F.col("o_custkey") % 3).alias("n_references"), F.col("o_orderstatus").alias("code"))
    return statement_tables.extraction_statistics(o, "title", "is_financial", "n_references", "code")


@query("v9_structure_issues", "SELECT o_orderkey, 'null_priority' AS issue FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT o_orderkey, 'no_sections' FROM orders")
def structure_issues(spark, d):
    """Reports that lack a field."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("priority"))
    return reports.structure_issues(o, ["priority", "sections"], "o_orderkey")


@query("v11_report_validation")
def report_validation(spark, d):
    """A score for every page from its sections and tables."""
    heading = F.col("tag").isin("h1", "h2", "h3")
    b = reports.blocks(table(spark, d, "pages"))
    s = reports.section_contents(reports.sections(b, heading), heading)
    t = reports.table_status(b.where("table_index is not null"))
    return reports.report_validation(s, t, 2).select("page_id", F.round("score", 6).alias("score"))


@query("p7_conditional_projection", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_totalprice > 50000 THEN 'middle' ELSE 'small' END AS size, o_orderstatus IN ('F', 'O') AND o_totalprice > 1000 AS chosen FROM orders")
def conditional_projection(spark, d):
    """Cases and predicates in a projection."""
    v = F.col("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", F.when(v > 200000, "large").when(v > 50000, "middle").otherwise("small").alias("size"), (F.col("o_orderstatus").isin("F", "O") & (v > 1000)).alias("chosen"))


@query("h7_subsections", "SELECT page_id, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages")
def page_subsections(spark, d):
    """Paragraphs counted as subsections of their page."""
    b = reports.sections(reports.blocks(table(spark, d, "pages")), F.col("tag") == "article")
    n = reports.subsections(b.where("tag = 'p'"), F.lit(True)).groupBy("page_id").agg(F.max("subsection_index").alias("paragraphs"))
    return table(spark, d, "pages").select("page_id").join(n, "page_id", "left").na.fill(0, ["paragraphs"]).withColumn("paragraphs", F.col("paragraphs").cast("long"))
