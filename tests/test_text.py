"""Column functions on hand-written values."""

import pytest
from pyspark.sql import functions as F

from brightledger.functions import ids
from brightledger.functions import text as T


def values(spark, texts, *functions, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [tuple(r)[1:] for r in df.select("i", *[f("t").alias(f"c{k}") for k, f in enumerate(functions)]).orderBy("i").collect()]


def one(spark, texts, f, kind="string"):
    return [r[0] for r in values(spark, texts, f, kind=kind)]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (T.financial_value, {"1,234": 1234, "(1,234)": -1234, "-5": -5, "-": None, "12-34": None, "3.5%": 3.5, "": None, None: None, "0": 0}),
        (T.period, {"제 56 (당) 기.1": "current", "제55(전)기": "previous", "주석": None, "당기": "current", None: None}),
        (T.note_numbers, {"4, 5": [4, 5], "Note 4": [4], "4)": [4], "④": [4], "": [], "7 and 3": [7, 3][::-1]}),
        (T.note_reference, {"4, 5": [4, 5], "4)": None, "12": [12]}),
        (T.hierarchy_level, {"자산": 1, "Ⅰ. 유 동 자 산": 2, "1. 현금": 3, "가. 세부": 4, "미처분": 5, "2024.12.31(당기말)": 1, "그 밖": 3}),
        (T.clean_label, {"Ⅰ. 유 동 자 산": "유동자산", "11. 제목": "제목", "2024.12.31 (당기말)": "2024.12.31(당기말)"}),
        (T.iso_date, {"2024년 2월 9일": "2024-02-09", "2024. 2. 9": "2024-02-09", "2024-1-3": "2024-01-03", "none": None}),
        (T.audit_opinion, {"부적정의견": "부적정의견", "적정의견": "적정의견", "감사인의 의견": "적정의견", "x": None}),
        (T.cell_text, {" 1,234 ": "1234", "(12)": "-12", "( 1,234,567 )": "-1234567"}),
        (T.statement_type, {"재무상태표": "BS", "포괄손익계산서": "PL", "x": None}),
        (T.currency_text, {"0": "0원", "12": "12원", "25000": "2.5만원", "-300000000": "-3.0억원", "2000000000000": "2.0조원"}),
        (T.writes, {"match (n) return n": False, "CREATE (n)": True, None: False}),
        (T.ownership_percentage, {"지분 51.2 %": 51.2, "120%": None, "none": None}),
        (T.loose_amount, {"1,234": 1234.0, "abc": None}),
        (T.intent, {"2023년 대비 증가율": "year_over_year", "자회사 목록": "subsidiaries", "hello": "company_info"}),
        (T.is_note_column, {"주 석": True, "Notes": True, "금액": False}),
    ],
)
def test_values(spark, f, cases):
    if f is T.currency_text:
        got = one(spark, list(cases), lambda c: f(F.col(c).cast("double")))
    else:
        got = one(spark, list(cases), f)
    assert got == list(cases.values())


def test_units(spark):
    got = one(spark, ["(단위: 백만원, %)", "no unit", "(단위 : 천주)"], T.units)
    assert [(u["unit"], u["type"], u["multiplier"]) for u in got[0]] == [("백만원", "money", 1_000_000), ("%", "percent", None)]
    assert got[1] is None
    assert (got[2][0]["type"], got[2][0]["multiplier"]) == ("shares", 1000)


def test_ownership_classes(spark):
    rows = [(50.0, "x"), (20.0, "x"), (49.9, "x"), (5.0, "공동기업"), (5.0, "x"), (None, "종속기업"), (None, "x"), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p double, k string")
    got = [r[0] for r in df.select(T.ownership_class("p", "k"), "i").orderBy("i").collect()]
    assert got == ["SUBSIDIARY", "AFFILIATE", "AFFILIATE", "JOINT_VENTURE", "SPECIAL_RELATION", "SUBSIDIARY", "SPECIAL_RELATION", "SPECIAL_RELATION"]


def test_ids(spark):
    import hashlib

    df = spark.createDataFrame([("  ABC\t", "x"), ("abc", "X"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(ids.sha1_id("a", "b")).collect()]
    assert got[0] == got[1] == hashlib.sha1(b"abc|x").hexdigest()
    assert got[2] is None
    assert set(ids.ID_PARTS) >= {"company", "note", "financial_trend"}


def test_amounts(spark):
    got = one(spark, ["매출 1,200백만원과 (300)억원"], T.amounts)[0]
    assert [(a["value"], a["unit"], a["negative"]) for a in got] == [(-300.0, "억원", True), (1200.0, "백만원", False)]


def test_richness_is_bounded(spark):
    df = spark.createDataFrame([("a b c",), ("",), ("word " * 500,)], "t string")
    got = [r[0] for r in df.select(T.richness("t", F.lit(5), F.lit(5))).collect()]
    assert got[1] == 0 and all(0 <= g <= 1 for g in got)


def test_positions(spark):
    df = spark.createDataFrame([("매출 1,000백만원 손실 (20)천원",), (None,), ("",)], "t string")
    found = [r.p and [(x.label, x.position, x.length) for x in r.p] for r in df.select(T.amount_positions("t").alias("p")).collect()]
    assert found == [[("positive", 3, 8), ("negative", 15, 6)], None, []]
    found = df.select(T.term_positions("t", {"매출": "REV", "손실": "LOSS"}).alias("p")).first().p
    assert [(x.label, x.position) for x in found] == [("REV", 0), ("LOSS", 12)]
