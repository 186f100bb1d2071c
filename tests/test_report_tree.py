"""Section trees and validations on pages that break the rules."""

from brightledger.operators import report_tree as R
from brightledger.operators import reports as B

PAGES = {
    1: '<p>lost</p><h2 class="SECTION-1">A</h2><p>a</p><h3 class="SECTION-2">주석</h3><p>n1</p><h3 class="SECTION-2">2. Two</h3><p>two</p><h2 class="x SECTION-1 y">외부감사 실시내용</h2>'
    '<p class="SECTION-2">1. One</p><p>one</p><p class="SECTION-2">주석 참고</p><p>lost</p><p class="SECTION-2">3. Three</p><table><tr><td>t</td></tr></table><p>three</p>',
    2: '<h3 class="SECTION-2">1. before all</h3><p>lost</p><h3 class="SECTION-2">3. 주석</h3><p>notes</p><h3 class="SECTION-2">주석</h3><p>second</p>',
    3: "",
    4: None,
    5: '<h2>no class</h2><p>x</p><h2 class="SECTION-1"></h2><p>no title, no heading</p><h2 class="SECTION-1">B</h2><h4 class="SECTION-9">4. Four</h4>',
}


def tree(spark):
    pages = spark.createDataFrame([(i, h, f"f_{2000 + i}.htm" if i < 3 else "f.htm", 1) for i, h in PAGES.items()], "page_id long, html string, source_file string, pos int")
    blocks = B.blocks(pages)
    return pages, R.section_tree(blocks), blocks


def test_grammar(spark):
    rows = tree(spark)[1].orderBy("page_id", "pos").collect()
    got = [(r.page_id, r.section_id, r.title, r.hierarchy_level, r.parent_id, r.section_number, r.content, r.n_tables) for r in rows]
    assert got == [
        (1, "SECTION-1-1", "A", 1, None, None, "a", 0), (1, R.NOTES_ID, "주석", 1, None, None, "n1", 0), (1, "SECTION-1-1-2", "2. Two", 2, "SECTION-1-1", 2, "two", 0),
        (1, "SECTION-1-2", "외부감사 실시내용", 1, None, None, "", 0), (1, "SECTION-1-2-1", "1. One", 2, "SECTION-1-2", 1, "one", 0), (1, "SECTION-1-2-3", "3. Three", 2, "SECTION-1-2", 3, "three", 1),
        (2, R.NOTES_ID, "3. 주석", 1, None, None, "notes", 0),
        (5, "SECTION-1-1", "B", 1, None, None, "", 0), (5, "SECTION-1-1-1", "4. Four", 2, "SECTION-1-1", 4, "", 0),
    ]


def test_one_shuffle(spark):
    plan = tree(spark)[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(page_id") == 1 and plan.count("Exchange") == 1


def test_records_and_validation(spark):
    pages, sections, blocks = tree(spark)
    records = R.reports(pages, sections, blocks)
    by = {r.page_id: r for r in records.collect()}
    assert sorted(by) == [1, 2, 3, 4, 5] and by[3].sections == [] and by[4].all_text == "" and by[1].metadata.report_year == 2001 and by[3].metadata.report_year is None
    assert [len(s.subsections) for s in by[1].sections] == [1, 0, 2] and by[1].metadata.total_subsections == 3 and by[1].title == "감사보고서"
    v = {r.page_id: r for r in R.validated_sections(records).collect()}
    assert v[3].missing_sections == ["재무제표", "주석", "감사의견"] and v[3].score == 0 and v[1].missing_sections == ["재무제표", "감사의견"] and v[1].score == 0.5
    assert "0:short_title" in v[1].issues and v[1].valid_sections == 3
    tables = B.table_status(blocks.where("table_index is not null")).selectExpr("page_id", "status", "true AS is_financial")
    whole = R.validated_reports(records, tables)
    w = {r.page_id: r for r in whole.collect()}
    assert w[3].structure_issues == ["no_report_year", "no_sections"] and abs(w[3].overall_score - (0.3 + 0.1 * 0.9)) < 1e-9 and w[1].total_tables == w[1].financial_tables == 1
    lines = [r.text for r in R.report_lines(whole.where("page_id = 1")).orderBy("line").collect()]
    assert lines[0].startswith("===") and "누락된 섹션: 재무제표, 감사의견" in lines and lines[-1] == ""
    assert R.section_tree(blocks.limit(0)).count() == 0 and R.reports(pages.limit(0), sections, blocks).count() == 0


def test_fields_of_a_wrong_type(spark):
    s = spark.createDataFrame([(("x", "PART-1", None, 0),)], "s struct<section_id: string, section_type: string, title: string, hierarchy_level: int>")
    assert s.select(R.section_field_issues(s.s).alias("i")).first().i == ["no_title", "bad_section_type", "bad_hierarchy_level", "short_title"]


def test_older_layouts(spark):
    rows = [("a", 1, "주석", 1, 2, "자산", 0), ("a", 2, None, None, 1, " ", None), ("b", 1, "x", 1, 0, None, 0)]
    flat = spark.createDataFrame(rows, "report string, pos int, title string, level int, section_number int, content string, n_subsections int")
    got = {r.report: r for r in R.validated_flat_sections(flat, "report").collect()}
    assert got["a"].issues == ["missing_재무제표", "missing_감사의견", "2:no_title", "2:no_level", "unordered"] and got["a"].warnings == ["1:notes_without_parts", "2:empty_content"]
    assert got["b"].issues[-1] == "1:no_content" and got["b"].valid_sections == 0
    typed = spark.createDataFrame([("a", "SECTION-1", "주석", None, 1), ("a", None, None, None, None)], "report string, section_type string, title string, n_details int, n_tables int")
    r = R.validated_main_sections(typed, "report").first()
    assert (r.issues, r.score, r.tables) == (["no_SECTION-2", "no_details"], 1 / 3, 1)
