"""Report trees, records and validations, on reports made of orders and their lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.operators import report_tree as R
from brightledger.operators import reports as B
from brightledger.operators.statement_tables import texts_financial
from brightledger.plans.registry import query
from brightledger.sources.scratch import written
from brightledger.sources.tables import CELLS_SQL, cells, table

# A report per order: an opinion, statements with a numbered part and a table for each line, notes, and for most an external audit.
# Some reports have a short first title, some headings begin nothing, and some parts are numbered where that counts for nothing.
LINES_SQL = """o AS (SELECT o_orderkey AS page_id, o_orderstatus AS status, o_custkey AS customer, year(o_orderdate) AS y, CASE WHEN o_orderkey % 5 = 0 THEN 'A' ELSE '감사의견' END AS first_title FROM orders),
l AS (SELECT l_orderkey AS page_id, l_suppkey AS supplier, l_returnflag AS flag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
tree AS (
  SELECT page_id, 'SECTION-1-1' AS section_id, 'SECTION-1' AS section_type, first_title AS title, 1 AS hierarchy_level, NULL AS parent_id, NULL AS parent_title, NULL AS section_number, 'opinion ' || status AS content, 0 AS n_tables FROM o
  UNION ALL SELECT page_id, 'SECTION-1-2', 'SECTION-1', '(첨부)재무제표', 1, NULL, NULL, NULL, 'intro', 0 FROM o
  UNION ALL SELECT page_id, 'SECTION-1-2-' || n, 'SECTION-2', n || '. ' || flag || ' 항목', 2, 'SECTION-1-2', '(첨부)재무제표', CAST(n AS INTEGER), 'supplier ' || supplier || chr(10) || 'after', 1 FROM l
  UNION ALL SELECT page_id, 'SECTION-2-INDEPENDENT', 'SECTION-2', '주석', 1, NULL, NULL, NULL, 'note ' || customer, 0 FROM o
  UNION ALL SELECT page_id, 'SECTION-1-3', 'SECTION-1', '외부감사 실시내용', 1, NULL, NULL, NULL, 'done', 0 FROM o WHERE page_id % 3 <> 0
  UNION ALL SELECT page_id, 'SECTION-1-3-2', 'SECTION-2', '1. 감사대상업무', 2, 'SECTION-1-3', '외부감사 실시내용', 1, 'scope', 0 FROM o WHERE page_id % 3 <> 0
)"""
TREE = "page_id", "section_id", "section_type", "title", "hierarchy_level", "parent_id", "parent_title", "section_number", "content", "n_tables"


def made_reports(spark, d):
    """``(page_id, source_file, html)`` of all orders."""
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    # Both sides are dealt by the key, small or not: pages are made and read by as many tasks as there are parts, not by those of a small file.
    o = table(spark, d, "orders").join(lines.hint("merge"), "o_orderkey", "left")

    def part(x, i):
        return F.concat(
            F.lit('<h3 class="SECTION-2">'), (i + 1).cast("string"), F.lit(". "), x["l_returnflag"], F.lit(" 항목</h3><p>supplier "), x["l_suppkey"].cast("string"),
            F.lit("</p><table><tr><td>part</td><td>"), x["l_partkey"].cast("string"), F.lit("</td></tr></table><p>after</p>"),
        )

    key = F.col("o_orderkey")
    parts = F.array_join(F.transform(F.coalesce("rows", F.array().cast("array<struct<l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,l_returnflag:string>>")), part), "\n")
    audit = F.lit(
        '<h2 class="SECTION-1">외부감사 실시내용</h2><p>done</p><p class="SECTION-2">머리말</p><p>lost</p><p class="SECTION-2">1. 감사대상업무</p><p>scope</p><h3 class="SECTION-2">9. 부록</h3><p>lost</p>'
    )
    html = F.concat(
        F.lit("<title>Report "), key.cast("string"), F.lit('</title><p>before</p><h2 class="SECTION-1">'), F.when(key % 5 == 0, "A").otherwise("감사의견"), F.lit("</h2><p>opinion "), F.col("o_orderstatus"),
        F.lit('</p><h2 class="SECTION-1 wide">(첨부)재무제표</h2><p>intro</p>'), parts, F.lit('<p class="SECTION-3">기타</p><p>lost</p><h3 class="SECTION-2">주석</h3><p>note '),
        F.col("o_custkey").cast("string"), F.lit("</p>"), F.when(key % 3 != 0, audit).otherwise(""),
    )
    return o.select(key.alias("page_id"), F.concat(F.lit("report_"), F.year("o_orderdate").cast("string"), F.lit(".htm")).alias("source_file"), html.alias("html"))


@query("h6_main_sections", f"WITH {LINES_SQL} SELECT * FROM tree WHERE hierarchy_level = 1")
def main_sections(spark, d):
    """Main sections and notes of reports, with their contents."""
    return R.page_sections(made_reports(spark, d)).where("hierarchy_level = 1").select(*TREE)


@query("h7_numbered_parts", f"WITH {LINES_SQL} SELECT * FROM tree WHERE hierarchy_level = 2")
def numbered_parts(spark, d):
    """Numbered parts of main sections, with the section that each is in."""
    return R.page_sections(made_reports(spark, d)).where("hierarchy_level = 2").select(*TREE)


def made_records(spark, d):
    return R.records(made_reports(spark, d))


RECORDS_SQL = f"""{LINES_SQL}, counted AS (SELECT page_id, count(*) FILTER (WHERE hierarchy_level = 1) AS tops, count(*) FILTER (WHERE hierarchy_level = 2) AS parts FROM tree GROUP BY 1),
read_text AS (SELECT o.page_id, 'Report ' || o.page_id || chr(10) || 'before' || chr(10) || first_title || chr(10) || 'opinion ' || status || chr(10) || '(첨부)재무제표' || chr(10) || 'intro' || chr(10)
  || coalesce(string_agg(n || '. ' || flag || ' 항목' || chr(10) || 'supplier ' || supplier || chr(10) || 'part' || chr(10) || partkey || chr(10) || 'after' || chr(10), '' ORDER BY n), '')
  || '기타' || chr(10) || 'lost' || chr(10) || '주석' || chr(10) || 'note ' || customer
  || CASE WHEN o.page_id % 3 <> 0 THEN chr(10) || array_to_string(['외부감사 실시내용', 'done', '머리말', 'lost', '1. 감사대상업무', 'scope', '9. 부록', 'lost'], chr(10)) ELSE '' END AS all_text
  FROM o LEFT JOIN (SELECT l_orderkey AS page_id, l_partkey AS partkey, l_suppkey AS supplier, l_returnflag AS flag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS n FROM lineitem) l ON o.page_id = l.page_id
  GROUP BY o.page_id, first_title, status, customer)"""


@query(
    "h24_report_records",
    f"""WITH {RECORDS_SQL} SELECT page_id, 'Report ' || page_id AS title, CAST(y AS INTEGER) AS report_year, CAST(tops AS INTEGER) AS total_sections, CAST(parts AS INTEGER) AS total_subsections,
  CAST(length(all_text) AS INTEGER) AS total_content_length, len(string_split(all_text, chr(10))) AS total_elements_parsed, sha256(all_text) AS text_sha256 FROM counted JOIN o USING (page_id) JOIN read_text USING (page_id)""",
)
def report_records(spark, d):
    """Records of reports: their counts, year, title and whole text."""
    r = made_records(spark, d)
    m = ("report_year", "total_sections", "total_subsections", "total_content_length")
    elements = F.col("metadata.total_elements_parsed").cast("long").alias("total_elements_parsed")
    return r.select("page_id", "title", *[f"metadata.{c}" for c in m], elements, F.sha2("all_text", 256).alias("text_sha256"))


@query(
    "h24_nested_sections",
    f"""WITH {LINES_SQL} SELECT t.page_id, t.section_id, t.title, coalesce(string_agg(p.title, '|' ORDER BY p.section_number), '') AS parts FROM tree t LEFT JOIN tree p ON p.page_id = t.page_id AND p.parent_id = t.section_id
WHERE t.hierarchy_level = 1 GROUP BY 1, 2, 3""",
)
def nested_sections(spark, d):
    """Sections of the records, with the titles of the parts that they hold."""
    s = made_records(spark, d).select("page_id", F.explode("sections").alias("s"))
    return s.select("page_id", "s.section_id", "s.title", F.array_join(F.transform("s.subsections", lambda p: p["title"]), "|").alias("parts"))


VALID_SQL = f"""{LINES_SQL}, found AS (SELECT page_id, CAST(count(*) FILTER (WHERE hierarchy_level = 1) AS INTEGER) AS total_sections, CAST(count(*) FILTER (WHERE hierarchy_level = 2) AS INTEGER) AS total_subsections,
  page_id % 5 = 0 AS short FROM tree GROUP BY 1), checked AS (
SELECT page_id, total_sections, total_sections AS valid_sections, total_subsections, CASE WHEN short THEN '감사의견' ELSE '' END AS missing_sections,
  CASE WHEN short THEN 'missing:감사의견|0:short_title' ELSE '' END AS issues, ((CASE WHEN short THEN 2 ELSE 3 END) + (CASE WHEN total_subsections > 0 THEN 1 ELSE 0 END)) / 4.0::DOUBLE AS score FROM found)"""


@query("v6_section_validation", f"WITH {VALID_SQL} SELECT page_id, total_sections, valid_sections, total_subsections, missing_sections, issues, score FROM checked")
def section_validation(spark, d):
    """Reports by their required sections, their fields and their parts."""
    v = R.validated_sections(made_records(spark, d))
    joined = {c: F.array_join(c, "|") for c in ("missing_sections", "issues")}
    return v.withColumns(joined).select("page_id", "total_sections", "valid_sections", "total_subsections", "missing_sections", "issues", "score")


@query(
    "v7_typed_sections",
    """WITH s AS (SELECT l_orderkey AS report, CASE WHEN l_linenumber % 4 = 3 THEN NULL WHEN l_returnflag = 'A' THEN 'SECTION-2' ELSE 'SECTION-1' END AS kind, CASE WHEN l_linenumber % 3 = 0 THEN '주석 사항' ELSE 'section' END AS title,
  CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE l_linenumber % 3 END AS details, l_linenumber % 2 AS tables FROM lineitem),
g AS (SELECT report, count(*) AS total_sections, list_sort(list(DISTINCT coalesce(kind, 'UNKNOWN'))) AS kinds, CAST(sum(details) AS BIGINT) AS details, CAST(sum(tables) AS BIGINT) AS tables, bool_or(contains(title, '주석')) AS notes FROM s GROUP BY 1),
i AS (SELECT *, list_filter(['SECTION-1', 'SECTION-2'], lambda t: NOT list_contains(kinds, t)) AS lacking FROM g)
SELECT report, total_sections, array_to_string(kinds, '|') AS section_types, details, tables,
  array_to_string(list_concat(list_transform(lacking, lambda t: 'no_' || t), CASE WHEN notes AND details = 0 THEN ['no_details'] ELSE [] END), '|') AS issues,
  (2 - len(lacking) + CASE WHEN details > 0 THEN 1 ELSE 0 END) / 3.0::DOUBLE AS score FROM i""",
)
def typed_sections(spark, d):
    """Reports of typed sections with detailed notes, the older layout, validated."""
    n = F.col("l_linenumber")
    s = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("report"), F.when(n % 4 == 3, None).when(F.col("l_returnflag") == "A", "SECTION-2").otherwise("SECTION-1").alias("section_type"),
        F.when(n % 3 == 0, "주석 사항").otherwise("section").alias("title"), F.when(F.col("l_suppkey") % 2 == 0, 0).otherwise(n % 3).alias("n_details"), (n % 2).alias("n_tables"),
    )
    v = R.validated_main_sections(s, "report")
    return v.withColumns({c: F.array_join(c, "|") for c in ("section_types", "issues")})


@query(
    "v7_flat_sections",
    """WITH s AS (SELECT l_orderkey AS report, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS pos, CASE WHEN l_linenumber = 3 THEN '재무제표' WHEN l_linenumber = 2 THEN '주석' ELSE 'x' END AS title, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 1 END AS level,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey % 3 END AS number, CASE l_returnflag WHEN 'A' THEN ' ' WHEN 'N' THEN '자산 총계' ELSE 'words' END AS content, l_suppkey % 2 AS n_subsections FROM lineitem),
w AS (SELECT *, coalesce(lag(coalesce(number, 0)) OVER (PARTITION BY report ORDER BY pos) > coalesce(number, 0), false) AS back,
  list_concat(CASE WHEN level IS NULL THEN ['no_level'] ELSE [] END, CASE WHEN number IS NULL THEN ['no_section_number'] ELSE [] END) AS fields,
  list_concat(CASE WHEN content = ' ' THEN ['empty_content'] ELSE [] END, CASE WHEN content = 'words' THEN ['no_financial_word'] ELSE [] END, CASE WHEN number = 2 AND title = '주석' AND n_subsections = 0 THEN ['notes_without_parts'] ELSE [] END) AS warns FROM s),
g AS (SELECT report, count(*) AS total_sections, count(*) FILTER (WHERE len(fields) = 0) AS valid_sections, bool_or(title = '재무제표') AS a, bool_or(title = '주석') AS b, bool_or(back) AS back,
  coalesce(string_agg(array_to_string(list_transform(fields, lambda x: pos || ':' || x), '|'), '|' ORDER BY pos) FILTER (WHERE len(fields) > 0), '') AS own,
  coalesce(string_agg(array_to_string(list_transform(warns, lambda x: pos || ':' || x), '|'), '|' ORDER BY pos) FILTER (WHERE len(warns) > 0), '') AS warnings FROM w GROUP BY 1)
SELECT report, total_sections, valid_sections, array_to_string(list_filter([CASE WHEN NOT a THEN 'missing_재무제표' END, CASE WHEN NOT b THEN 'missing_주석' END, 'missing_감사의견', nullif(own, ''), CASE WHEN back THEN 'unordered' END], lambda x: x IS NOT NULL), '|') AS issues, warnings FROM g""",
)
def flat_sections(spark, d):
    """Reports of flat numbered sections, the oldest layout, validated."""
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("report"), (n.cast("long") * 1000000000 + F.col("l_partkey") * 10000 + s).alias("pos"), F.when(n == 3, "재무제표").when(n == 2, "주석").otherwise("x").alias("title"), F.when(s % 7 != 0, 1).alias("level"),
        F.when(s % 5 != 0, s % 3).alias("section_number"), F.when(F.col("l_returnflag") == "A", " ").when(F.col("l_returnflag") == "N", "자산 총계").otherwise("words").alias("content"), (s % 2).alias("n_subsections"),
    )
    return R.validated_flat_sections(rows, "report").withColumns({c: F.array_join(c, "|") for c in ("issues", "warnings")})


@query("v10_bracketed_amounts", f"WITH {CELLS_SQL} SELECT table_id, count(*) FILTER (WHERE regexp_matches(text, '[0-9]') AND contains(text, '(') AND contains(text, ')')) AS bracketed FROM cells GROUP BY 1")
def bracketed_amounts(spark, d):
    """Cells of each table whose figures stand in brackets."""
    return R.bracketed_amounts(cells(spark, d))


def _validated(spark, d):
    records = R.records(made_reports(spark, d), tables=True)
    # Some records have lost their year, some have that of the file before.
    year = F.when(F.col("page_id") % 7 == 0, None).when(F.col("page_id") % 11 == 0, F.col("metadata.report_year") - 1).otherwise(F.col("metadata.report_year"))
    records = records.withColumn("metadata", F.col("metadata").withField("report_year", year))
    tables = F.transform("tables", lambda t: F.struct(B.texts_status(t).alias("status"), texts_financial(t, ("part",)).alias("is_financial")))
    # Pages are read once, as reports are both scored and printed; what is written is their validation alone.
    return written(R.validated_reports(records.withColumn("tables", tables)))


TABLES_SQL = f"""{VALID_SQL}, tabled AS (SELECT page_id, count(*) AS n FROM l GROUP BY 1), whole AS (
SELECT c.*, coalesce(n, 0) AS n, CASE WHEN page_id % 7 = 0 THEN 'no_report_year' WHEN page_id % 11 = 0 THEN 'other_year' ELSE '' END AS structure FROM checked c LEFT JOIN tabled USING (page_id)), scored AS (
SELECT *, 0.6::DOUBLE * score + 0.3::DOUBLE * 1 + 0.1::DOUBLE * (1 - 0.05::DOUBLE * CASE WHEN structure = '' THEN 0 ELSE 1 END) AS overall FROM whole)"""


@query("v11_validated_reports", f"WITH {TABLES_SQL} SELECT page_id, n AS total_tables, n AS valid_tables, n AS financial_tables, CAST(0 AS BIGINT) AS empty_tables, structure AS structure_issues, round(overall, 6) AS overall_score FROM scored")
def validated_reports(spark, d):
    """Whole reports validated: sections, tables, structure and the overall score."""
    v = _validated(spark, d)
    return v.select("page_id", "total_tables", "valid_tables", "financial_tables", "empty_tables", F.array_join("structure_issues", "|").alias("structure_issues"), F.round("overall_score", 6).alias("overall_score"))


@query(
    "v11_report_lines",
    f"""WITH {TABLES_SQL} SELECT page_id, unnest(list_transform(range(len(t)), lambda i: CAST(i AS INTEGER))) AS line, unnest(t) AS text FROM (SELECT page_id, list_concat(
  ['=== 데이터 검증 리포트 ===', '', '전체 품질 점수: ' || format('{{:.2f}}', overall) || '/1.00', '', '=== 섹션 검증 결과 ===', '총 섹션 수: ' || total_sections, '유효한 섹션 수: ' || valid_sections],
  CASE WHEN missing_sections <> '' THEN ['누락된 섹션: ' || missing_sections] ELSE [] END, ['', '=== 테이블 검증 결과 ===', '총 테이블 수: ' || n, '유효한 테이블 수: ' || n, '재무 테이블 수: ' || n, '빈 테이블 수: 0', ''],
  CASE WHEN structure || issues <> '' THEN list_concat(['=== 발견된 문제점 ==='], list_transform(list_filter(list_concat(string_split(structure, '|'), string_split(issues, '|')), lambda x: x <> ''), lambda x: '- ' || x), ['']) ELSE [] END) AS t FROM scored)""",
)
def report_lines(spark, d):
    """The text reports of all validations, line by line."""
    return R.report_lines(_validated(spark, d))
