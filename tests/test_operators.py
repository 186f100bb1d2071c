"""Operators on hand-written rows, and what must hold whatever the rows."""

import math

from pyspark.sql import functions as F

from brightledger.operators import graph, hierarchy, notes, relations, reports, statement_tables, trends, upsert


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_change(spark):
    cases = [(110.0, 100.0, 10, "increasing"), (103.0, 100.0, 3, "stable"), (5.0, 0.0, 100, "increasing"), (-5.0, 0.0, -100, "decreasing"), (0.0, 0.0, 0, "stable"), (50.0, -100.0, 150, "increasing")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(cases)], "i int, a double, b double")
    got = rows(df.withColumns(trends.change(F.col("a"), F.col("b"))).select("i", "change_rate", "trend_direction"), "i")
    assert [(round(r, 6), d) for _, r, d in got] == [(r, d) for *_, r, d in cases]


def test_growth_and_volatility(spark):
    series = {"a": [100, -5, 121], "b": [0, 7], "c": [100, 110, 121], "d": [4]}
    df = spark.createDataFrame([(k, y, float(v)) for k, vs in series.items() for y, v in enumerate(vs)], "k string, year int, value double")
    got = {r.k: (round(r.g, 6), round(r.v, 6)) for r in df.groupBy("k").agg(trends.growth_rate("value", "year").alias("g"), trends.volatility("value").alias("v")).collect()}
    assert {k: g for k, (g, _) in got.items()} == {"a": 21, "b": 0, "c": 10, "d": 0}
    assert got["d"][1] == 0 and math.isclose(got["c"][1], 10.503968, rel_tol=1e-6)


def test_paths(spark):
    levels = [1, 2, 3, 3, 2, 4, 1, 3, 4, 2, 3, 5]
    want = "S>A S>A>B S>A>B>C S>A>B>D S>A>E S>F S>G S>H S>H>I S>G>J S>G>J>K S>L".split()
    df = spark.createDataFrame([(1, i, lv, chr(65 + i)) for i, lv in enumerate(levels)], "table_id int, pos int, level int, name string")
    got = [r[0] for r in hierarchy.label_paths(df, root="S").orderBy("pos").select("category_path").collect()]
    assert got == want


def test_upserts_are_idempotent(spark):
    target = spark.createDataFrame([(1, 1, "a", None), (2, 1, "b", "x")], "id int, seq int, a string, b string")
    batch = spark.createDataFrame([(2, 2, "c", None), (2, 3, "d", None), (3, 1, None, "y")], "id int, seq int, a string, b string")
    once = upsert.last_wins(target, batch)
    assert rows(once, "id") == [(1, 1, "a", None), (2, 3, "d", None), (3, 1, None, "y")]
    assert rows(upsert.last_wins(once, batch), "id") == rows(once, "id")
    filled = upsert.first_wins(target, batch, ["id"], ["a", "b"])
    assert rows(filled, "id") == [(1, "a", None), (2, "b", "x"), (3, None, "y")]
    assert rows(upsert.first_wins(filled, batch, ["id"], ["a", "b"]), "id") == rows(filled, "id")


def test_edges_need_both_ends(spark):
    e = spark.createDataFrame([(1, 2, "t"), (1, 2, "t"), (1, 9, "t"), (9, 2, "t")], "src_id int, dst_id int, rel_type string")
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(upsert.existing_edges(e, ids, ids), "src_id") == [(1, 2, "t")] or upsert.existing_edges(e, ids, ids).count() == 1
    assert upsert.dangling_edges(e, ids, "dst_id").count() == 1


def test_merged_relations(spark):
    e = spark.createDataFrame([("p", "c", 5.0, 2022, None, 1), ("p", "c", 9.0, 2023, "asia", 2)], "s string, d string, amount double, year int, region string, seq int")
    got = upsert.merged_edges(e, ["s", "d"], "amount", ["year", "region"], "seq").collect()
    assert [tuple(r) for r in got] == [("p", "c", 9.0, 2022, "asia")]


def test_trade_fan_out(spark):
    df = spark.createDataFrame([("p", "t", 500.0, 300.0, 1), ("p", "u", 0.0, None, 2)], "parent string, company string, sales double, buys double, seq int")
    got = rows(relations.trade_relations(df, "parent", "company", "sales", "buys"), "amount")
    assert [(r[0], r[1], r[4], r[5]) for r in got] == [("t", "p", "inbound", 300.0), ("p", "t", "outbound", 500.0)]


def test_unit_inheritance(spark):
    units = ["백만원", None, None, "천원", None]
    df = spark.createDataFrame([(1, i, u) for i, u in enumerate(units)], "f int, i int, unit string")
    got = rows(statement_tables.inherited_units(df, "f", "i", "unit").select("i", "effective_unit", "unit_inherited"), "i")
    assert [(u, h) for _, u, h in got] == [("백만원", False), ("백만원", True), (None, False), ("천원", False), ("천원", True)]


def test_statement_index(spark):
    t = spark.createDataFrame([("r", 3, "포 괄 손 익 계 산 서"), ("r", 5, "손익계산서"), ("r", 7, "기타")], "table_id string, table_index int, text string")
    words = {"PL": ["손익계산서"], "CI": ["포괄손익계산서"]}
    assert rows(statement_tables.statement_index(t, words), "table_index") == [("r", 4, "CI"), ("r", 6, "PL")]


def test_note_merge(spark):
    texts = [(2, 1, "first part of the note two"), (2, 2, "second part of the note two"), (3, 3, "x" * 30), (3, 4, "y" * 45), (4, 5, "z" * 10)]
    df = spark.createDataFrame([(1, *t) for t in texts], "k int, number int, seq int, content string")
    got = rows(notes.merge_notes(df, ["k"], "number", "seq", "content"), "number")
    assert [(n, t) for _, n, t, *_ in got] == [(2, f"{texts[0][2]}\n\n{texts[1][2]}"), (3, "y" * 45)]


def test_split_notes(spark):
    df = spark.createDataFrame([(1, "1. 일반적 사항: 본문\n2. 회계정책\n내용")], "k int, content string")
    got = rows(notes.split_notes(df, "k", "content").select("note_number", "title", "body"), "note_number")
    assert got == [(1, "일반적 사항", "본문"), (2, "회계정책", "내용")]


def test_classification_defaults_to_the_first(spark):
    df = spark.createDataFrame([("law thing",), ("nothing",)], "t string")
    got = rows(notes.classify(df, "t", {"a": ("zzz",), "b": ("law", "x")}).select("t", "category", "confidence"), "t")
    assert got == [("law thing", "b", 0.5), ("nothing", "a", 0.0)]


def test_orphans_and_duplicates(spark):
    n = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "id int, label string")
    e = spark.createDataFrame([(1, 3)], "src_id int, dst_id int")
    assert rows(graph.orphans(n, e), "id") == [(2, "a")]
    assert rows(graph.duplicate_ids(n), "id") == [(1, 2, "a,b")]


REPORT = """<html><head><title>R</title></head><body><h2 class="SECTION-1">1. 개요</h2><p>머리<br>글</p><p>&nbsp;</p>
<h2 class="SECTION-1">2. 재무</h2><table><tr><td>(단위: 백만원)</td></tr></table>
<table><tr><th>과 목</th><th>당기</th></tr><tr><td>자산</td><td>(1,234)</td></tr></table><p>끝</p></body></html>"""


def test_report_blocks(spark):
    pages = spark.createDataFrame([(1, REPORT), (2, None), (3, "")], "page_id long, html string")
    b = reports.blocks(pages)
    heading = F.col("class") == "SECTION-1"
    s = reports.section_contents(reports.sections(b, heading), heading)
    got = {r.section_index: (r.title, r.content) for r in s.where("page_id = 1").collect()}
    assert got[1] == ("1. 개요", "머리 글") and got[2] == ("2. 재무", "끝")
    cells = rows(b.where("table_index = 1").select("row_index", "col_index", "text"), "row_index", "col_index")
    assert cells == [(0, 0, "과 목"), (0, 1, "당기"), (1, 0, "자산"), (1, 1, "(1,234)")]


def test_decoding(spark):
    df = spark.createDataFrame([("가나".encode("euc-kr"),), ("é".encode(),), (None,)], "c binary")
    assert [r[0] for r in df.select(reports.decoded("c")).collect()][0] == "가나"


def test_cleaning(spark):
    html = "<h3 x>a<P>b</h3></P><span>c</span><script>d</script><p> <br/> </p>e<br><br/>f"
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(reports.cleaned("h")).first()[0] == "<h3 x>ab</h3>ce<br>f"


def test_routed_cells(spark):
    cells = spark.createDataFrame(
        [
            (1, 0, "회사명", " Korea A "), (1, 1, "회사명", "elsewhere"), (1, 2, "지분율", "12.5"), (1, 3, "당기말", "-"), (1, 4, "당기말", "1,000"), (1, 5, "당기말", "2,000"), (1, 6, None, "x"),
            (2, 0, "회사명", "elsewhere"), (3, 0, "회사명", None), (4, 0, "비고", "담보 Korea 1,234,567"), (4, 1, "보증처", "Korea B"), (5, 0, "비고", "담보 Korea 12,345"),
        ],
        "id int, col_index int, column_name string, text string",
    )
    found = relations.investments_of_cells(cells.where("id < 4"), ["id"], "id", ("Korea",)).collect()
    assert [(r.dst_id, r.ownership_percentage, r.amount, r.book_value) for r in found] == [("Korea A", 12.5, 2000.0, None)]
    found = relations.guarantees_of_cells(cells, ["id"], "id", ("Korea",)).collect()
    assert [(r.id, r.dst_id, r.amount, r.guarantee_type) for r in found] == [(4, "Korea B", 1234567.0, "collateral")]
