"""Files and stores: what is written is read back, and pages are mended before they are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.functions.ids import ID_PARTS, node_id
from brightledger.functions.note_words import NO_SUBCATEGORY, NOTE_CATEGORIES
from brightledger.operators import graph, notes, report_tree, reports
from brightledger.plans.dictionary_queries import NOTES_SQL, PARTS_SQL, _best, made_notes
from brightledger.plans.registry import query
from brightledger.plans.statement_pipeline import build
from brightledger.plans.tree_queries import LINES_SQL, made_records
from brightledger.sources import store as S
from brightledger.sources.scratch import fresh_path, written
from brightledger.sources.tables import EDGES_SQL, STATEMENTS_SQL, company_edges, statements, table


@query(
    "h1_mended_headings",
    "SELECT c_custkey, '<h3 class=\"t\">제목 ' || c_name || '</h3><p>text</p>' AS html FROM customer",
)
def mended_headings(spark, d):
    """Headings that a paragraph has been opened in, mended."""
    html = F.concat(F.lit('<h3 class="t">제목 <P>'), F.col("c_name"), F.lit("</h3></P><p>text</p>"))
    return table(spark, d, "customer").select("c_custkey", html.alias("html")).select("c_custkey", reports.cleaned("html").alias("html"))


@query(
    "h3_without_empty_layout",
    "SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN '<p>x</p>' WHEN 1 THEN '<br>y' WHEN 2 THEN '' ELSE '<div>z</div>' END AS html FROM customer",
)
def without_empty_layout(spark, d):
    """Pages without empty layout tags, runs of line breaks single."""
    k = F.col("c_custkey") % 4
    rest = F.when(k == 0, '<p class="e"> &nbsp;<br/></p><p>x</p><div>\n</div>').when(k == 1, "<br/> <BR><br />y").when(k == 2, "<span></span><div><br></div>").otherwise("<script>var a = '<p>';</script><div>z</div><meta a='b'>")
    return table(spark, d, "customer").select("c_custkey", F.concat("c_name", rest).alias("html")).select("c_custkey", reports.cleaned("html").alias("html"))


@query(
    "h10_note_blocks",
    """SELECT c_custkey, 1 AS note_number, '일반' AS title, '회사' || CASE WHEN c_custkey % 2 = 0 THEN ' 다시' ELSE '' END AS body FROM customer UNION ALL SELECT c_custkey, 2, '정책 ' || c_mktsegment, '첫 번째' FROM customer
UNION ALL SELECT c_custkey, 12, '끝', c_mktsegment FROM customer WHERE c_custkey % 3 > 0""",
)
def note_blocks(spark, d):
    """Numbered blocks of running text, the last title of each number."""
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    text = F.concat(
        F.lit("머리 1. 일반: 회사 2. 정책 "), segment, F.lit(": 첫 번째\n2. 정책 "), segment, F.lit(": 두 번째 "), F.when(k % 2 == 0, "1. 일반: 회사 다시 ").otherwise(""), F.when(k % 3 > 0, F.concat(F.lit("12. 끝: "), segment, F.lit("\n"))).otherwise(""),
    )
    return notes.note_blocks(table(spark, d, "customer").select("c_custkey", text.alias("t")), "c_custkey", "t")


@query("s4_report_identity", "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) WHEN o_orderkey % 3 = 1 THEN 2014 + o_orderkey % 11 ELSE 2014 END AS INTEGER) AS report_year FROM orders")
def report_identity(spark, d):
    """The year of a report: declared, else that of its file's name, else the first year of all."""
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_orderkey", F.when(k % 3 == 0, F.year("o_orderdate")).alias("declared"), F.when(k % 3 == 1, F.concat(F.lit("r_1999_"), (2014 + k % 11).cast("string"), F.lit(".htm"))).otherwise("r_1999.htm").alias("name"))
    return S.report_year(o, "declared", "name").select("o_orderkey", "report_year")


@query("s14_started_over", "SELECT 'nodes' AS name, count(*) AS n, CAST(1 AS BIGINT) AS versions FROM supplier WHERE s_acctbal > 0")
def started_over(spark, d):
    """A store that is started over: the second load is all there is."""
    store = S.Store(spark, fresh_path(spark))
    nodes = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal")
    store.write({"nodes": nodes, "others": nodes})
    store.write({"nodes": nodes.where("s_acctbal > 0")}, replace=True, confirm=True)
    return store.read("nodes").agg(F.lit("nodes").alias("name"), F.count(F.lit(1)).alias("n"), F.lit(len(store.versions())).cast("long").alias("versions"))


@query("s16_backup_restored", f"WITH {EDGES_SQL} SELECT 'edges' AS name, rel_type AS kind, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM edges GROUP BY 2 UNION ALL SELECT 'nodes', s_name, 1, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) FROM supplier")
def backup_restored(spark, d):
    """Nodes and edges backed up and restored, counted and summed."""
    path = fresh_path(spark)
    S.backup({"nodes": table(spark, d, "supplier"), "edges": company_edges(spark, d)}, path)
    back = S.restored(spark, path, ["nodes", "edges"])
    edges = back["edges"].groupBy(F.col("rel_type").alias("kind")).agg(F.lit("edges").alias("name"), F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"))
    nodes = back["nodes"].select(F.col("s_name").alias("kind"), F.lit("nodes").alias("name"), F.lit(1).cast("long").alias("n"), F.col("s_acctbal").cast("decimal(18,2)").cast("double").alias("total"))
    return edges.unionByName(nodes)


@query("s19_issues_sink", "SELECT severity, count(*) AS n FROM (SELECT CASE WHEN n = 0 THEN 'critical' ELSE 'warning' END AS severity FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) WHERE n < 9) GROUP BY 1")
def issues_sink(spark, d):
    """Issues of customers with few orders, written as JSON and read back with their counts by severity."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    issues = graph.coverage(table(spark, d, "customer"), o, "c_custkey", 9)
    path = fresh_path(spark)
    S.write_issues(issues, path)
    summary = spark.read.json(f"{path}/summary")
    found = spark.read.json(f"{path}/issues").groupBy("severity").agg(F.count(F.lit(1)).alias("m"))
    return found.join(summary, "severity").where("m = n").select("severity", "n")


@query(
    "s20_classified_notes",
    f"""WITH {NOTES_SQL}, scored AS (SELECT note, t, {_best(NOTE_CATEGORIES, 't')} AS best FROM made), c AS (SELECT note, 2014 + note % 11 AS year, best.name AS category, CASE best.name {PARTS_SQL} ELSE '{NO_SUBCATEGORY}' END AS subcategory FROM scored)
SELECT CAST(year AS BIGINT) AS year, category, subcategory, count(*) AS n FROM c WHERE year < 2020 GROUP BY 1, 2, 3""",
)
def classified_notes_of_years(spark, d):
    """Notes classified and written by year, read back for some years."""
    c = notes.classified(made_notes(spark, d), "title", "content").withColumn("year", 2014 + F.col("note") % 11)
    path = fresh_path(spark)
    kept = c.select("note", "year", "category", "subcategory", "confidence")
    S.write_classified_notes(kept, notes.classification_summary(kept, "category", "year", "confidence"), path)
    read = S.or_empty(spark, f"{path}/notes", "note long, category string, subcategory string, confidence double, year long")
    return read.where("year < 2020").groupBy("year", "category", "subcategory").agg(F.count(F.lit(1)).alias("n"))


@query("s21_missing_notes", "SELECT o_orderpriority AS category, count(*) AS n FROM orders GROUP BY 1")
def missing_notes(spark, d):
    """A table of notes that is not there reads as an empty one, and joins as one."""
    none = S.or_empty(spark, f"{fresh_path(spark)}/none", "note long, category string")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("note"), "o_orderpriority")
    return o.join(none, "note", "left").groupBy(F.coalesce("category", "o_orderpriority").alias("category")).agg(F.count(F.lit(1)).alias("n"))


# --- texts that differ from row to row

WORDS = tuple(dict.fromkeys(w for ws in T.STATEMENTS.values() for w in ws)) + ("주석", "자산", "기타")


@query(
    "f9_types_of_texts",
    f"""WITH w AS (SELECT {list(WORDS)} AS pool), t AS (SELECT o_orderkey, pool[o_orderkey % {len(WORDS)} + 1] || ' 및 ' || pool[o_custkey % {len(WORDS)} + 1] AS s FROM orders, w)
SELECT o_orderkey, CASE {' '.join(f"WHEN {' OR '.join(f"contains(s, '{w}')" for w in ws)} THEN '{c}'" for c, ws in T.STATEMENTS.items())} END AS kind FROM t""",
)
def types_of_texts(spark, d):
    """The statement that each of many titles names first in order of statements."""
    pool, n = F.array(*map(F.lit, WORDS)), len(WORDS)
    s = F.concat_ws(" 및 ", *[F.element_at(pool, (F.col(c) % n).cast("int") + 1) for c in ("o_orderkey", "o_custkey")])
    return table(spark, d, "orders").select("o_orderkey", T.statement_type(s).alias("kind"))


@query(
    "f24_ownership_of_texts",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_suppkey % 120 + 0.5 AS DOUBLE) END AS text_share FROM lineitem WHERE l_suppkey % 120 + 0.5 <= 100 OR l_partkey % 2 = 1",
)
def ownership_of_texts(spark, d):
    """Shares written in texts: a figure with a percent sign, or none."""
    n = (F.col("l_suppkey") % 120).cast("string")
    text = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("지분율 "), n, F.lit(".5% 보유"))).otherwise("지분을 보유")
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.ownership_percentage(text).alias("text_share"))
    return l.where("text_share is not null or l_partkey % 2 = 1")


# --- plans and structure of reports


@query(
    "s18_planned_load",
    f"""WITH {LINES_SQL}, p AS (SELECT page_id, 'report_' || y || '.htm' AS source_file, CAST(count(*) FILTER (WHERE hierarchy_level = 1) AS INTEGER) AS sections, CAST(count(*) FILTER (WHERE title = '주석') AS INTEGER) AS notes FROM tree JOIN o USING (page_id) GROUP BY 1, 2)
SELECT source_file, CAST(sum(sections) AS BIGINT) AS sections, CAST(sum(notes) AS BIGINT) AS notes, CAST(sum(40 + notes) AS BIGINT) AS estimated_nodes, CAST(sum(2 * (40 + notes)) AS BIGINT) AS estimated_edges FROM p GROUP BY 1
UNION ALL SELECT 'TOTAL', CAST(sum(sections) AS BIGINT), CAST(sum(notes) AS BIGINT), CAST(sum(40 + notes) AS BIGINT), CAST(sum(2 * (40 + notes)) AS BIGINT) FROM p""",
)
def planned_load(spark, d):
    """How many nodes and edges a load of reports would make, by file and in all."""
    return report_tree.planned_load(made_records(spark, d))


STRUCTURES = (
    '{"version":"3.0","source_filename":"f","report_year":2020,"sections":[],"tables":[]}', '{"version":"3.0","source_filename":"f","report_year":null,"sections":[{"title":"t"}]}', '{"version":null,"report_year":"2020","sections":{},"tables":7}', "[1]", "{broken", '{"sections":[],"tables":[],"report_year":2020.5}',
)


@query(
    "v9_typed_structure",
    """SELECT o_orderkey, unnest(CASE o_orderkey % 7 WHEN 1 THEN ['no_tables'] WHEN 2 THEN ['no_source_filename', 'bad_report_year', 'bad_sections', 'bad_tables'] WHEN 3 THEN ['corrupt'] WHEN 4 THEN ['corrupt'] WHEN 5 THEN ['no_version', 'no_source_filename', 'bad_report_year'] WHEN 6 THEN ['corrupt'] ELSE [] END) AS issue FROM orders""",
)
def typed_structure(spark, d):
    """What parsed reports lack, what is of a wrong type, and which are no records at all."""
    k = (F.col("o_orderkey") % 7).cast("int")
    json = F.when(k < 6, F.element_at(F.array(*map(F.lit, STRUCTURES)), F.least(k, F.lit(5)) + 1))
    o = table(spark, d, "orders").select("o_orderkey", json.alias("json"))
    return report_tree.typed_structure(o, "o_orderkey", "json")


@query(
    "h14_heads_and_feet",
    "SELECT c_custkey AS page_id, c_custkey % 3 <> 0 AS has_header, c_custkey % 2 = 0 AS has_footer, CAST(CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS head_cells, CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS foot_cells FROM customer",
)
def heads_and_feet(spark, d):
    """Tables with heads of either kind, and with feet."""
    k = F.col("c_custkey")
    head = F.when(k % 3 == 1, "<thead><tr><td>항목</td><td><p>당기</p></td></tr></thead><tbody>").when(k % 3 == 2, "<tr><th><div>항목</div></th></tr>").otherwise("")
    foot = F.when(k % 2 == 0, "<tfoot><tr><td>합계</td></tr></tfoot>").otherwise("")
    html = F.concat(F.lit("<table>"), head, F.lit("<tr><td>"), F.col("c_name"), F.lit("</td><td>5</td></tr>"), foot, F.lit("</table>"))
    blocks = reports.blocks(table(spark, d, "customer").select(k.alias("page_id"), html.alias("html")))
    return reports.table_parts(blocks).drop("table_index")


# --- nodes of the load


@query("u2_category_names", f"""WITH {NOTES_SQL}, scored AS (SELECT note, t, {_best(NOTE_CATEGORIES, 't')} AS best FROM made), c AS (SELECT best.name AS category, CASE best.name {PARTS_SQL} ELSE '{NO_SUBCATEGORY}' END AS subcategory FROM scored)
SELECT category AS note_category FROM c UNION SELECT subcategory FROM c""")
def category_names(spark, d):
    """All categories and subcategories that notes fall into, each once."""
    return notes.category_names(notes.classified(made_notes(spark, d), "title", "content"))


@query(
    "d14_statement_nodes",
    f"""WITH {STATEMENTS_SQL} SELECT 'companies' AS label, sha1('company') AS id, NULL AS section_code, NULL AS year, NULL AS value UNION ALL SELECT DISTINCT 'sections', sha1('company|' || lower(section_code)), section_code, NULL, NULL FROM statements
UNION ALL SELECT DISTINCT 'years', sha1('company|' || lower(section_code) || '|' || year), section_code, year, NULL FROM statements
UNION ALL SELECT 'data', sha1('company|' || year || '|' || lower(item_name) || '|' || lower(section_code)), section_code, year, CAST(value AS DOUBLE) FROM statements""",
)
def statement_nodes(spark, d):
    """Companies, statements, years and data of a load, with their ids."""
    made = build(written(statements(spark, d)))
    frames = []
    for label in ("companies", "sections", "years", "data"):
        t = made[label]
        own = [F.col(c).cast(k).alias(c) if c in t.columns else F.lit(None).cast(k).alias(c) for c, k in (("section_code", "string"), ("year", "int"), ("value", "double"))]
        frames.append(t.select(F.lit(label).alias("label"), "id", *own))
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


def _id_sql(parts) -> str:
    return "sha1(" + " || '|' || ".join(f"'{p.strip(chr(39))}'" if p.startswith("'") else f"lower('{p} ' || c_custkey)" for p in parts) + ")"


@query("f2_all_node_ids", " UNION ALL ".join(f"SELECT '{label}' AS label, c_custkey, {_id_sql(parts)} AS id FROM customer" for label, parts in ID_PARTS.items()))
def all_node_ids(spark, d):
    """The ids of all kinds of nodes, from parts that need trimming and lower case."""
    c = table(spark, d, "customer")
    made = []
    for label, parts in ID_PARTS.items():
        columns = {p: F.concat(F.lit(f"  {p.upper()} "), F.col("c_custkey").cast("string"), F.lit("\t")) for p in parts if not p.startswith("'")}
        made.append(F.struct(F.lit(label).alias("label"), node_id(label, **columns).alias("id")))
    return c.select("c_custkey", F.explode(F.array(*made)).alias("n")).select("n.label", "c_custkey", "n.id")
