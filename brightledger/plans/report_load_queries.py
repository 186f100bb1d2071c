"""The load of reports under SQL, on a report for each customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.plans.registry import query
from brightledger.plans.report_load import report_tables
from brightledger.sources.tables import dealt, table

FILLER = "이 문단은 보고서의 길이를 채우기 위한 설명이며 특별한 내용은 없다. " * 3


def made_reports(spark, d):
    """``(page_id, company, year, html)``: opinions in texts and in tables, statements with a table, numbered notes."""
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    key = k.cast("string")
    opinion = F.when(k % 3 == 0, "한정의견").when(k % 3 == 1, "감사인의 의견").otherwise("보고")
    who = F.when(k % 4 == 0, "삼 일 회계법인").when(k % 4 == 1, "삼정kpmg").otherwise("")
    day = F.when(k % 5 == 0, F.concat(F.lit("2020년 3월 "), (k % 28 + 1).cast("string"), F.lit("일"))).otherwise("")
    audit = F.concat(F.lit('<h2 class="SECTION-1">독립된 감사인의 감사보고서</h2><p>감사 '), opinion, F.lit(" "), who, F.lit(" "), day, F.lit(f" {FILLER}</p>"))
    review = F.concat(F.lit('<h2 class="SECTION-1">내부회계관리제도 검토</h2><table><tr><td>법인</td><td>안진회계법인</td></tr><tr><td>일자</td><td>2021. 4. '), (k % 28 + 1).cast("string"), F.lit("</td></tr></table>"))
    statement = F.concat(
        F.lit(f'<h2 class="SECTION-1">(첨부)재무제표</h2><p>{FILLER}'), key, F.lit("</p><table><tr><td>"), segment, F.lit(" 부문의 주요한 항목에 대한 설명 및 그 밖의 모든 사항</td><td>비고</td></tr><tr><td>둘째 줄의 값 "), key,
        F.lit("</td><td>또한 그러하며 그 밖에는 더 말할 것이 없다고 한다</td></tr></table>"),
    )
    notes = F.concat(F.lit('<h3 class="SECTION-2">주석</h3><p>1. 일반사항: 회사는 '), segment, F.lit(f" 부문의 회계정책과 회계기준을 따르며 소송은 없다 {FILLER.strip()}</p><p>2. 우발부채: 보증 및 담보 "), key, F.lit("건과 소송 및 분쟁이 있다고 한다</p><p>3. 짧다: x</p>"))
    html = F.concat(audit, F.when(k % 2 == 0, review).otherwise(""), statement, notes)
    return dealt(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").select(k.alias("page_id"), (k % 50).alias("company"), (F.lit(2000) + F.floor(k / 50)).cast("int").alias("year"), html.alias("html"))


_FILL = FILLER.strip()
MADE_SQL = f"""c AS (SELECT c_custkey AS k, CAST(c_custkey % 50 AS VARCHAR) AS company, CAST(2000 + c_custkey // 50 AS INTEGER) AS year, c_mktsegment AS segment FROM customer),
audits AS (SELECT company, year, '독립감사의견' AS audit_type, CASE k % 4 WHEN 0 THEN '삼일회계법인' WHEN 1 THEN '삼정KPMG' END AS auditor, CASE k % 3 WHEN 0 THEN '한정의견' WHEN 1 THEN '적정의견' END AS opinion,
    CASE WHEN k % 5 = 0 THEN '2020-03-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') END AS audit_date FROM c WHERE k % 4 < 2 OR k % 3 < 2 OR k % 5 = 0
  UNION ALL SELECT company, year, '내부회계관리제도', '안진회계법인', NULL, '2021-04-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') FROM c WHERE k % 2 = 0),
audit_nodes AS (SELECT sha1(company || '|' || year || '|' || audit_type) AS id, * FROM audits),
notes AS (SELECT company, year, 1 AS note_number, '일반사항' AS title, '회사는 ' || segment || ' 부문의 회계정책과 회계기준을 따르며 소송은 없다 {_FILL}' AS content, '회계정책' AS category, '기준' AS subcategory FROM c
  UNION ALL SELECT company, year, 2, '우발부채', '보증 및 담보 ' || k || '건과 소송 및 분쟁이 있다고 한다', '우발부채', '기타' FROM c),
note_nodes AS (SELECT sha1(company || '|' || year || '|' || note_number) AS id, * FROM notes),
docs AS (
  SELECT company, year, 'section' AS doc_type, '독립된 감사인의 감사보고서' AS title, 'section_SECTION-1-1' AS anchor, regexp_replace('감사 ' || CASE k % 3 WHEN 0 THEN '한정의견' WHEN 1 THEN '감사인의 의견' ELSE '보고' END || ' ' || CASE k % 4 WHEN 0 THEN '삼 일 회계법인' WHEN 1 THEN '삼정kpmg' ELSE '' END || ' '
    || CASE WHEN k % 5 = 0 THEN '2020년 3월 ' || (k % 28 + 1) || '일' ELSE '' END || ' {_FILL}', ' +', ' ', 'g') AS content, NULL AS note FROM c
  UNION ALL SELECT company, year, 'section', '(첨부)재무제표', 'section_SECTION-1-' || CASE WHEN k % 2 = 0 THEN 3 ELSE 2 END, '{_FILL} ' || k, NULL FROM c
  UNION ALL SELECT company, year, 'section', '주석', 'section_SECTION-2-INDEPENDENT', '1. 일반사항: ' || n.content || ' 2. 우발부채: ' || m.content || ' 3. 짧다: x', NULL FROM notes n JOIN notes m USING (company, year) WHERE n.note_number = 1 AND m.note_number = 2
  UNION ALL SELECT company, year, 'note', title, 'note_' || note_number, content, note_number FROM notes WHERE length(content) >= 50
  UNION ALL SELECT company, year, 'table', 'Table 1 from 내부회계관리제도 검토 (Financial)', 'table_SECTION-1-2_0_' || year, 'Table from: 내부회계관리제도 검토 법인 안진회계법인 일자 2021. 4. ' || (k % 28 + 1), NULL FROM c WHERE k % 2 = 0 AND length('Table from: 내부회계관리제도 검토 법인 안진회계법인 일자 2021. 4. ' || (k % 28 + 1)) >= 50
  UNION ALL SELECT company, year, 'table', 'Table 1 from (첨부)재무제표 (Financial)', 'table_SECTION-1-' || CASE WHEN k % 2 = 0 THEN 3 ELSE 2 END || '_0_' || year,
    'Table from: (첨부)재무제표 ' || segment || ' 부문의 주요한 항목에 대한 설명 및 그 밖의 모든 사항 비고 둘째 줄의 값 ' || k || ' 또한 그러하며 그 밖에는 더 말할 것이 없다고 한다', NULL FROM c),
doc_nodes AS (SELECT sha1(company || '|' || year || '|' || doc_type || '|' || lower(anchor)) AS id, * FROM docs)"""


@query("d12_report_audits", f"WITH {MADE_SQL} SELECT id, company, year, audit_type, auditor, opinion, audit_date FROM audit_nodes")
def report_audits(spark, d):
    """Audits of reports: from texts and from cells, one for each company, year and type."""
    a = report_tables(made_reports(spark, d))["audits"]
    return a.select("id", F.col("company").cast("string").alias("company"), "year", "audit_type", "auditor", "opinion", "audit_date")


@query("d13_report_notes", f"WITH {MADE_SQL} SELECT id, company, year, note_number, title, content, category, subcategory FROM note_nodes")
def report_notes(spark, d):
    """Notes of reports, by category and subcategory."""
    n = report_tables(made_reports(spark, d))["notes"]
    return n.select("id", F.col("company").cast("string").alias("company"), "year", "note_number", "title", "content", "category", "subcategory")


@query("d11_report_documents", f"WITH {MADE_SQL} SELECT id, company, year, doc_type, title, anchor, content, CAST(length(content) AS INTEGER) AS content_length, note AS note_number FROM doc_nodes")
def report_documents(spark, d):
    """Search documents of sections, notes and tables of reports."""
    s = report_tables(made_reports(spark, d))["search_documents"]
    return s.select("id", F.col("company").cast("string").alias("company"), "year", "doc_type", "title", "anchor", "content", "content_length", "note_number")


@query(
    "d16_report_edges",
    f"""WITH {MADE_SQL} SELECT DISTINCT sha1(company) AS src_id, id AS dst_id, 'has_note' AS rel_type FROM note_nodes UNION ALL SELECT DISTINCT id, sha1(unnest([category, subcategory])), 'has_note_category' FROM note_nodes
UNION ALL SELECT DISTINCT sha1(company), id, 'has_audit_info' FROM audit_nodes UNION ALL SELECT DISTINCT sha1(company), sha1(lower(auditor)), 'audited_by' FROM audit_nodes WHERE auditor IS NOT NULL
UNION ALL SELECT DISTINCT sha1(company), id, 'related_to' FROM doc_nodes UNION ALL SELECT DISTINCT n.id, d.id, 'related_to' FROM doc_nodes d JOIN note_nodes n ON n.company = d.company AND n.year = d.year AND n.note_number = d.note""",
)
def report_edges(spark, d):
    """All edges of the reports' load."""
    return report_tables(made_reports(spark, d))["edges"].select("src_id", "dst_id", "rel_type")
