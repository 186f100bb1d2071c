"""Scalar functions and statement tables over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.operators import statement_tables as ST
from brightledger.plans.registry import query
from brightledger.sources.tables import CELLS_SQL, cells, table

PARSED = """CASE WHEN regexp_replace(text, '[, ]', '', 'g') IN ('', '-') THEN NULL WHEN text LIKE '(%' OR text LIKE '-%'
  THEN -TRY_CAST(regexp_replace(text, '[^0-9.]', '', 'g') AS DOUBLE) ELSE TRY_CAST(regexp_replace(text, '[^0-9.]', '', 'g') AS DOUBLE) END"""


@query("f17_financial_values", f"WITH {CELLS_SQL} SELECT table_id, row_index, col_index, text, {PARSED} AS value FROM cells WHERE col_index >= 2")
def financial_values(spark, d):
    """Printed cells read as numbers."""
    return cells(spark, d).where("col_index >= 2").select("table_id", "row_index", "col_index", "text", T.financial_value("text").alias("value"))


@query(
    "w6_period_rows",
    f"""WITH {CELLS_SQL} SELECT table_id, row_index, min(text) FILTER (WHERE col_index = 0) AS item_name, max({PARSED}) FILTER (WHERE col_index = 2) AS values_current,
  max({PARSED}) FILTER (WHERE col_index = 3) AS values_previous, min(text) FILTER (WHERE col_index = 1) AS note_numbers FROM cells GROUP BY 1, 2""",
)
def period_rows(spark, d):
    """Statement rows: label, current and previous value, note numbers."""
    out = ST.period_values(cells(spark, d))
    return out.withColumn("note_numbers", F.array_join(F.transform("note_numbers", lambda x: x.cast("string")), ", "))


@query("f13_note_numbers", f"WITH {CELLS_SQL}, s AS (SELECT table_id, row_index, text, CAST(split_part(text, ', ', 1) AS INT) AS a, CAST(split_part(text, ', ', 2) AS INT) AS b FROM cells WHERE col_index = 1) SELECT table_id, row_index, text, CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE least(a, b) || ',' || greatest(a, b) END AS numbers FROM s")
def note_number_lists(spark, d):
    """Note references as sorted distinct numbers."""
    c = cells(spark, d).where("col_index = 1")
    return c.select("table_id", "row_index", "text", F.array_join(F.transform(T.note_numbers("text"), lambda x: x.cast("string")), ",").alias("numbers"))


@query("f15_periods", f"WITH {CELLS_SQL} SELECT column_name, CASE WHEN contains(column_name, '(당)') THEN 'current' WHEN contains(column_name, '(전)') THEN 'previous' END AS period, contains(column_name, '주석') AS is_note, count(*) AS n FROM cells GROUP BY ALL")
def periods(spark, d):
    """Column names as periods and note columns."""
    c = cells(spark, d).groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    return c.select("column_name", T.period("column_name").alias("period"), T.is_note_column("column_name").alias("is_note"), "n")


LABELS = """labels_ AS (SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN '자산' WHEN 1 THEN 'Ⅰ. 유 동 ' || c_mktsegment WHEN 2 THEN CAST(c_custkey % 20 AS VARCHAR) || '. ' || c_mktsegment
  WHEN 3 THEN '가. ' || c_mktsegment WHEN 4 THEN '미처분 ' || c_mktsegment ELSE '2024.12.31 (당기말)' END AS label, c_mktsegment AS seg FROM customer)"""


def _labels(spark, d):
    c, k, seg = table(spark, d, "customer"), F.col("c_custkey"), F.col("c_mktsegment")
    label = (
        F.when(k % 6 == 0, F.lit("자산")).when(k % 6 == 1, F.concat(F.lit("Ⅰ. 유 동 "), seg)).when(k % 6 == 2, F.concat((k % 20).cast("string"), F.lit(". "), seg))
        .when(k % 6 == 3, F.concat(F.lit("가. "), seg)).when(k % 6 == 4, F.concat(F.lit("미처분 "), seg)).otherwise("2024.12.31 (당기말)")
    )
    return c.select(k.alias("id"), label.alias("label"))


@query(
    "f20_hierarchy_levels",
    f"""WITH {LABELS} SELECT id, label, CASE id % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 ELSE 1 END AS level,
  CASE id % 6 WHEN 0 THEN '자산' WHEN 1 THEN '유동 ' || seg WHEN 2 THEN seg WHEN 3 THEN seg WHEN 4 THEN '미처분 ' || seg ELSE '2024.12.31(당기말)' END AS clean FROM labels_""",
)
def hierarchy_levels(spark, d):
    """Levels and clean names of numbered labels."""
    return _labels(spark, d).select("id", "label", T.hierarchy_level("label").alias("level"), T.clean_label("label").alias("clean"))


@query("a6_row_totals", f"WITH {CELLS_SQL}, v AS (SELECT table_id, row_index, TRY_CAST(replace(replace(regexp_replace(text, '[, ]', '', 'g'), '(', '-'), ')', '') AS DOUBLE) AS value FROM cells WHERE col_index >= 2) SELECT table_id, row_index, sum(value) AS value, '항목명' AS item_name FROM v WHERE value <> 0 GROUP BY 1, 2")
def row_totals(spark, d):
    """Rows with the sum of their numbers and their name."""
    c = cells(spark, d).where("col_index <> 1").withColumn("text", F.when(F.col("col_index") == 0, "항목명").otherwise(F.col("text")))
    return ST.row_totals(c)


@query(
    "h14_table_metadata",
    f"""WITH {CELLS_SQL}, m AS (SELECT table_id, count(DISTINCT row_index) AS row_count, count(DISTINCT col_index) AS column_count, count(*) FILTER (WHERE trim(text) = '') AS empty_cells, count(*) AS n_cells,
  round(avg(CASE WHEN regexp_matches(regexp_replace(text, '[, ]', '', 'g'), '^-?\\(?[0-9]') AND NOT (col_index = 0) THEN 1 ELSE 0 END), 6) AS r FROM cells WHERE col_index >= 2 OR col_index = 0 GROUP BY 1)
SELECT table_id, row_count, column_count, empty_cells, 'valid' AS status FROM m""",
)
def table_metadata(spark, d):
    """Size, empty cells and validity of each table."""
    m = ST.table_metadata(cells(spark, d).where("col_index <> 1"), ("자산",))
    return m.select("table_id", "row_count", "column_count", "empty_cells", "status")


@query("h15_column_types", f"WITH {CELLS_SQL}, r AS (SELECT table_id, col_index, avg(CASE WHEN regexp_full_match(regexp_replace(text, '[,.\\s()\\-]', '', 'g'), '[0-9]+') THEN 1 ELSE 0 END) AS ratio FROM cells GROUP BY 1, 2) SELECT table_id, col_index, CASE WHEN ratio > 0.8 THEN 'numeric_string' ELSE 'text' END AS data_type FROM r")
def column_types(spark, d):
    """The type of each column by the share of numbers in it."""
    return ST.column_types(cells(spark, d))


@query("h13_numbered_columns", f"WITH {CELLS_SQL}, c AS (SELECT DISTINCT table_id, col_index FROM cells), n AS (SELECT *, row_number() OVER (PARTITION BY table_id, col_index >= 2 ORDER BY col_index) - 1 AS k FROM c) SELECT table_id, col_index, CASE WHEN col_index >= 2 THEN '금액' ELSE '항목' END || CASE WHEN k > 0 THEN '_' || CAST(k AS VARCHAR) ELSE '' END AS column_name FROM n")
def numbered_columns(spark, d):
    """Columns of one name told apart."""
    c = cells(spark, d).select("table_id", "col_index").distinct()
    return ST.numbered_columns(c.withColumn("column_name", F.when(F.col("col_index") >= 2, "금액").otherwise(" 항목 ")))


UNITS = """CASE o_orderstatus WHEN 'F' THEN '(단위: 백만원, %)' WHEN 'O' THEN '(단위 : 천원)' ELSE '금액' END"""


def _unit_text():
    return F.when(F.col("o_orderstatus") == "F", "(단위: 백만원, %)").when(F.col("o_orderstatus") == "O", "(단위 : 천원)").otherwise("금액")


@query("h16_units", f"SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '백만원' WHEN 'O' THEN '천원' END AS unit, CASE o_orderstatus WHEN 'F' THEN 1000000 WHEN 'O' THEN 1000 END AS multiplier, CASE o_orderstatus WHEN 'F' THEN '백만원,%' WHEN 'O' THEN '천원' END AS all_units FROM orders")
def unit_remarks(spark, d):
    """Units read from remarks."""
    o = table(spark, d, "orders").select("o_orderkey", T.units(_unit_text()).alias("u"))
    return o.select("o_orderkey", F.col("u")[0]["unit"].alias("unit"), F.col("u")[0]["multiplier"].alias("multiplier"), F.array_join(F.transform("u", lambda x: x["unit"]), ",").alias("all_units"))


@query(
    "h18_inherited_units",
    """WITH t AS (SELECT o_custkey AS fragment, o_orderkey AS i, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS unit FROM orders), l AS (SELECT *, lag(unit) OVER (PARTITION BY fragment ORDER BY i) AS before FROM t)
SELECT fragment, i, coalesce(unit, before) AS effective_unit, unit IS NULL AND before IS NOT NULL AS unit_inherited FROM l""",
)
def inherited_units(spark, d):
    """A table's unit goes on to the next table."""
    t = table(spark, d, "orders").select(F.col("o_custkey").alias("fragment"), F.col("o_orderkey").alias("i"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("unit"))
    return ST.inherited_units(t, "fragment", "i", "unit").select("fragment", "i", "effective_unit", "unit_inherited")


@query("f19_scaled_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN round_even(o_totalprice * 1000000, 0) WHEN 'O' THEN round_even(o_totalprice * 1000, 0) ELSE o_totalprice END AS scaled FROM orders")
def scaled_values(spark, d):
    """Values in whole units by the table's unit."""
    o = table(spark, d, "orders").withColumn("u", T.units(_unit_text())[0])
    return ST.scaled_values(o, F.col("o_totalprice"), table_unit="u").select("o_orderkey", "scaled")


NAMES = "CASE o_orderkey % 5 WHEN 0 THEN '포 괄 손 익 계 산 서' WHEN 1 THEN '재무상태표' WHEN 2 THEN '손익계산서' WHEN 3 THEN '현금 흐름표' ELSE '기타' END"


@query(
    "h25_statement_index",
    f"""WITH t AS (SELECT o_custkey AS table_id, o_orderkey AS i, replace({NAMES}, ' ', '') AS name FROM orders)
SELECT table_id, i + 1 AS table_index, CASE name WHEN '포괄손익계산서' THEN 'CI' WHEN '재무상태표' THEN 'BS' WHEN '손익계산서' THEN 'PL' WHEN '현금흐름표' THEN 'CF' END AS section_code FROM t WHERE name <> '기타'""",
)
def statement_index(spark, d):
    """Which table holds which statement, by the title before it."""
    k = F.col("o_orderkey") % 5
    name = F.when(k == 0, "포 괄 손 익 계 산 서").when(k == 1, "재무상태표").when(k == 2, "손익계산서").when(k == 3, "현금 흐름표").otherwise("기타")
    t = table(spark, d, "orders").select(F.col("o_custkey").alias("table_id"), F.col("o_orderkey").alias("table_index"), name.alias("text"))
    words = {"BS": ["재무상태표"], "PL": ["손익계산서"], "CI": ["포괄손익계산서"], "CF": ["현금흐름표"], "EQ": ["자본변동표"]}
    return ST.statement_index(t, words)


@query(
    "h26_section_dedupe",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderstatus = 'F' AS INT) DESC, o_orderkey % 7 DESC, o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def section_dedupe(spark, d):
    """One section per key: with data first, then the most tables, then the first."""
    best = F.max(F.struct((F.col("o_orderstatus") == "F").alias("has"), (F.col("o_orderkey") % 7).alias("tables"), (-F.col("o_orderkey")).alias("seq")))
    return table(spark, d, "orders").groupBy("o_custkey").agg(best.alias("b")).select("o_custkey", (-F.col("b.seq")).alias("o_orderkey"))


@query("f36_statement_scores", "SELECT doc_id, CASE WHEN a + b + c = 0 THEN NULL WHEN a >= b AND a >= c THEN 'BS' WHEN b >= c THEN 'CF' ELSE 'EQ' END AS section_code, greatest(a, b, c) AS score FROM (SELECT doc_id, CAST(contains(lower(text), 'the') AS INT) + CAST(contains(lower(text), 'ing') AS INT) AS a, CAST(contains(lower(text), 'de') AS INT) + CAST(contains(lower(text), 'eau') AS INT) + CAST(contains(lower(text), 'ion') AS INT) AS b, CAST(contains(lower(text), 'der') AS INT) + CAST(contains(lower(text), 'keit') AS INT) AS c FROM documents)")
def statement_scores(spark, d):
    """A text's class by the number of indicator words."""
    words = {"BS": ("the", "ing"), "CF": ("de", "eau", "ion"), "EQ": ("der", "keit")}
    return ST.section_scores(table(spark, d, "documents"), words, "doc_id", "text")


@query("f7_percentages", "SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '([0-9]+(?:\\.[0-9]+)?)[ \\t\\n]*%', 1), lambda x: CAST(CAST(x AS DOUBLE) AS VARCHAR)), ',') AS percentages FROM documents")
def percentages(spark, d):
    """Percentages in texts."""
    t = table(spark, d, "documents")
    return t.select("doc_id", F.array_join(F.transform(T.percentages("text"), lambda x: x.cast("string")), ",").alias("percentages"))


TERMS = {"the": "EN", "der": "DE", "que": "FR", "los": "ES"}


@query(
    "f8_term_counts",
    " UNION ALL ".join(f"SELECT doc_id, '{t}' AS term, '{c}' AS code, (length(text) - length(replace(text, '{t}', ''))) // {len(t)} AS n FROM documents WHERE contains(text, '{t}')" for t, c in TERMS.items()),
)
def term_counts(spark, d):
    """How often each dictionary term occurs in each text."""
    t = table(spark, d, "documents").select("doc_id", F.explode(T.term_counts("text", TERMS)).alias("t"))
    return t.select("doc_id", "t.term", "t.code", "t.n")


@query(
    "f10_richness",
    """WITH w AS (SELECT doc_id, text, greatest(len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')), 1) AS words, length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS n,
  (length(text) - length(replace(text, 'the', ''))) // 3 AS terms, len(regexp_extract_all(text, '[0-9]+')) AS numbers FROM documents)
SELECT doc_id, round(CASE WHEN n > 0 THEN least(least(10.0 * terms / words, 0.4) + least(10.0 * numbers / words, 0.3) + CAST(n > 100 AS INT) * 0.1 + CAST(n > 500 AS INT) * 0.1 + CAST(n > 1000 AS INT) * 0.1, 1.0) ELSE 0 END, 6) AS richness FROM w""",
)
def richness(spark, d):
    """How much each text has to say."""
    t = table(spark, d, "documents")
    score = T.richness("text", F.regexp_count("text", F.lit("the")), F.regexp_count("text", F.lit("[0-9]+")))
    return t.select("doc_id", F.round(score, 6).alias("richness"))


@query("f11_text_issues", "SELECT doc_id, CASE WHEN NOT contains(text, 'the') AND NOT contains(text, 'der') THEN 'no_terms' END AS terms, CASE WHEN NOT regexp_matches(text, '[0-9]') THEN 'no_digits' END AS digits FROM documents")
def text_issues(spark, d):
    """What texts lack."""
    t = table(spark, d, "documents").withColumn("i", T.text_issues("text", ("the", "der")))
    return t.select("doc_id", F.when(F.array_contains("i", "no_terms"), "no_terms").alias("terms"), F.when(F.array_contains("i", "no_digits"), "no_digits").alias("digits"))


@query("f5_cell_text", f"WITH {CELLS_SQL} SELECT table_id, row_index, text, CASE row_index % 5 WHEN 1 THEN '-' || regexp_replace(text, '[()]', '', 'g') WHEN 2 THEN replace(text, ',', '') ELSE text END AS clean FROM cells WHERE col_index = 2")
def cell_texts(spark, d):
    """Printed cells without separators, bracketed numbers negative."""
    return cells(spark, d).where("col_index = 2").select("table_id", "row_index", "text", T.cell_text("text").alias("clean"))


@query("f6_amounts", "SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS value, '백만원' AS unit, false AS negative FROM orders UNION ALL SELECT o_orderkey, -CAST(o_custkey AS DOUBLE), '천원', true FROM orders")
def amounts(spark, d):
    """Amounts with their units taken out of running text."""
    t = F.concat(F.lit("매출 "), F.col("o_orderkey").cast("string"), F.lit("백만원, 손실 ("), F.col("o_custkey").cast("string"), F.lit(")천원"))
    return table(spark, d, "orders").select("o_orderkey", F.explode(T.amounts(t)).alias("a")).select("o_orderkey", "a.value", "a.unit", "a.negative")


@query("f6_amount_positions", "SELECT o_orderkey, 'positive' AS label, 3 AS position, length(CAST(o_orderkey AS VARCHAR)) + 3 AS length FROM orders UNION ALL SELECT o_orderkey, 'negative', 3 + length(CAST(o_orderkey AS VARCHAR)) + 3 + 5, length(CAST(o_custkey AS VARCHAR)) + 4 FROM orders")
def amount_positions(spark, d):
    """Where the amounts of running text are."""
    t = F.concat(F.lit("매출 "), F.col("o_orderkey").cast("string"), F.lit("백만원, 손실 ("), F.col("o_custkey").cast("string"), F.lit(")천원"))
    return table(spark, d, "orders").select("o_orderkey", F.explode(T.amount_positions(t)).alias("a")).select("o_orderkey", "a.label", "a.position", "a.length")


@query(
    "f8_term_positions",
    "WITH w AS (" + " UNION ALL ".join(f"SELECT doc_id, '{c}' AS label, {len(t)} AS length, string_split(lower(text), '{t}') AS p FROM documents" for t, c in TERMS.items()) + """), q AS (
  SELECT doc_id, label, length, generate_subscripts(p, 1) AS i, len(p) AS k, length(unnest(p)) AS n FROM w
), r AS (SELECT doc_id, label, length, i, k, sum(n) OVER (PARTITION BY doc_id, label ORDER BY i) + (i - 1) * length AS position FROM q)
SELECT doc_id, label, CAST(position AS INTEGER) AS position, length FROM r WHERE i < k""",
)
def term_positions(spark, d):
    """Where the dictionary terms of each text are."""
    t = table(spark, d, "documents").select("doc_id", F.explode(T.term_positions("text", TERMS)).alias("t"))
    return t.select("doc_id", "t.label", "t.position", "t.length")


@query("f31_currency", "SELECT o_orderkey, CASE WHEN v >= 1e12 THEN printf('%.1f조원', v / 1e12) WHEN v >= 1e8 THEN printf('%.1f억원', v / 1e8) WHEN v >= 1e4 THEN printf('%.1f만원', v / 1e4) WHEN v = 0 THEN '0원' ELSE format('{:,.0f}원', v) END AS printed FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(floor(o_totalprice / 100) AS DOUBLE) ELSE CAST(floor(o_totalprice) AS DOUBLE) * CASE o_orderkey % 3 WHEN 1 THEN 1024 ELSE 16777216 END END AS v FROM orders)")
def currency(spark, d):
    """Money as displayed."""
    k, price = F.col("o_orderkey") % 3, F.col("o_totalprice")
    v = F.when(k == 0, F.floor(price / 100).cast("double")).otherwise(F.floor(price).cast("double") * F.when(k == 1, 1024).otherwise(16777216))
    return table(spark, d, "orders").select("o_orderkey", T.currency_text(v).alias("printed"))


RULES = (("greeting", ("the", "hello")), ("number", ("ing",)), ("place", ("que", "der")))


def _rule_sql(column: str) -> str:
    whens = " ".join(f"WHEN {' OR '.join(f'contains(lower({column}), {w!r})' for w in words)} THEN '{label}'" for label, words in RULES)
    return f"CASE {whens} ELSE 'other' END"


@query("f32_question_intents", f"SELECT conv_id, turn, {_rule_sql('text')} AS intent FROM conversations WHERE role = 'user'")
def question_intents(spark, d):
    """Questions by intent, the first rule that fits."""
    q = table(spark, d, "conversations").where("role = 'user'")
    return q.select("conv_id", "turn", T.intent("text", RULES, "other").alias("intent"))


@query("f34_limited_by_intent", f"WITH q AS (SELECT conv_id, turn, {_rule_sql('text')} AS intent FROM conversations WHERE role = 'user') SELECT conv_id, turn, intent FROM (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY conv_id, turn) AS r FROM q) WHERE r <= CASE intent WHEN 'greeting' THEN 20 WHEN 'number' THEN 10 ELSE 50 END")
def limited_by_intent(spark, d):
    """So many rows for each intent."""
    q = question_intents(spark, d)
    most = F.coalesce(F.create_map(F.lit("greeting"), F.lit(20), F.lit("number"), F.lit(10))[F.col("intent")], F.lit(50))
    ranked = q.withColumn("r", F.row_number().over(W.partitionBy("intent").orderBy("conv_id", "turn")))
    # The first bound is a plain number, so rows beyond it are dropped before the shuffle.
    return ranked.where("r <= 50").where(F.col("r") <= most).drop("r")


@query("f33_read_only_guard", "SELECT conv_id, turn, regexp_matches(text, '(?i)\\b(CREATE|MERGE|SET|DELETE|REMOVE|LOAD\\s+CSV|CALL\\s|APOC\\.|DROP|DETACH|INDEX|CONSTRAINT|PROCEDURE|FUNCTION)\\b') AS writes FROM conversations")
def read_only_guard(spark, d):
    """Which texts hold a clause that writes."""
    return table(spark, d, "conversations").select("conv_id", "turn", T.writes("text").alias("writes"))


@query(
    "f29_audit_fields",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS audit_date, CASE o_orderkey % 3 WHEN 0 THEN '부적정의견' WHEN 1 THEN '적정의견' ELSE '한정의견' END AS opinion, CASE o_orderkey % 2 WHEN 0 THEN '삼일회계법인' ELSE '안진회계법인' END AS auditor,
  CASE o_orderkey % 3 WHEN 0 THEN '내부회계관리제도' WHEN 1 THEN '독립감사의견' ELSE '감사의견' END AS audit_type FROM orders""",
)
def audit_fields(spark, d):
    """Date, opinion, auditor and type read from audit sections."""
    k = F.col("o_orderkey")
    style = F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy'년 'M'월 'd'일'")).otherwise(F.date_format("o_orderdate", "yyyy'. 'M'. 'd"))
    opinion = F.when(k % 3 == 0, "부적정의견").when(k % 3 == 1, "감사인의 의견").otherwise("한정의견")
    who = F.when(k % 2 == 0, "삼 일 회 계 법 인").otherwise("안진 회계법인")
    title = F.when(k % 3 == 0, "내부회계관리제도 검토").when(k % 3 == 1, "독립된 감사인의 보고서").otherwise("감사 보고")
    o = table(spark, d, "orders").select("o_orderkey", F.concat_ws(" ", style, opinion, F.lit("감사"), who).alias("content"), title.alias("title"))
    return o.select("o_orderkey", T.iso_date("content").alias("audit_date"), T.audit_opinion("content").alias("opinion"), T.auditor("content").alias("auditor"), T.audit_type("title").alias("audit_type"))


@query("f3_normal_text", "SELECT o_orderkey, 'USD' || CAST(o_custkey AS VARCHAR) || ' (x) 5백만원...' AS clean FROM orders")
def normal_texts(spark, d):
    """Text normalised: signs, units, brackets, punctuation."""
    t = F.concat(F.lit("  $"), F.col("o_custkey").cast("string"), F.lit(" ( x )  5 백만원.....  "))
    return table(spark, d, "orders").select("o_orderkey", T.normal_text(t).alias("clean"))


@query("s5_year_of_name", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def year_of_name(spark, d):
    """The year in a file's name."""
    name = F.concat(F.lit("report_"), F.year("o_orderdate").cast("string"), F.lit(".htm"))
    return table(spark, d, "orders").select("o_orderkey", F.regexp_extract(name, r"(\d{4})", 1).try_cast("int").alias("year"))


@query("f35_looks_financial", f"WITH {CELLS_SQL} SELECT table_id, bool_or(contains(lower(text), 'r항목')) OR avg(CAST(regexp_matches(text, '[0-9,()]') AS INT)) > 0.2 AS financial FROM cells WHERE col_index = 0 OR row_index % 5 = 0 AND col_index = 2 GROUP BY 1")
def looks_financial(spark, d):
    """Which tables have a financial word, or figures in some of their cells."""
    c = cells(spark, d).where("col_index = 0 or row_index % 5 = 0 and col_index = 2")
    return ST.looks_financial(c.withColumn("column_name", F.lit("x")), ("r항목",))


@query(
    "s7_statement_index",
    f"""WITH t AS (SELECT o_custkey AS file, CAST(o_orderkey % 9 AS INTEGER) AS table_index, o_orderkey AS seq, o_orderpriority AS section_code FROM orders)
SELECT file, table_index, max_by(section_code, seq) AS section_code FROM t GROUP BY 1, 2""",
)
def statement_index_map(spark, d):
    """The stored index of statement tables: of sections that name one table, the later one has it."""
    from brightledger.sources.store import statement_index_map as later

    o = table(spark, d, "orders")
    return later(o.select(F.col("o_custkey").alias("file"), (F.col("o_orderkey") % 9).cast("int").alias("table_index"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("section_code")))
