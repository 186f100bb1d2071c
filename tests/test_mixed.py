"""Variants, containment, chains, units and templates on odd input."""

import json
import random

import pytest
from pyspark.sql import functions as F

from brightledger.functions import variants as V
from brightledger.operators import graph, notes, units
from brightledger.plans import templates


def test_cells_keep_their_kinds(spark):
    rows = [("주석", "1, 20,3"), ("주석", " 4 "), ("비고", "see 5"), ("주석", None), ("금액", "1,234"), ("금액", "-5.50"), ("금액", "(7)"), ("금액", "  "), ("금액", "12345678901234567890"), ("주석", "99999999999")]
    df = spark.createDataFrame(rows, "name string, text string").select("name", "text", V.cell("text", "name").alias("v"))
    assert df.schema["v"].dataType.simpleString() == "variant"
    got = [tuple(r) for r in df.select(V.kind("v"), V.text_of("v"), V.number_of("v"), V.notes_of("v")).collect()]
    assert got == [
        ("notes", "1, 20,3", None, [1, 20, 3]), ("notes", "4", None, [4]), ("object", "see 5", None, None), ("null", None, None, None), ("number", None, 1234.0, None), ("number", None, -5.5, None),
        ("text", "(7)", None, None), ("null", None, None, None), ("number", None, 12345678901234567890.0, None), ("object", "99999999999", None, None),
    ]
    first = json.loads(df.select(F.to_json("v").alias("j")).first().j)
    assert first == {"type": "notes_reference", "note_numbers": [1, 20, 3], "original_value": "1, 20,3", "reference_count": 3}


def test_strings_of_anything(spark):
    values = [None, "null", '" a "', '""', "[]", '[" b ", null, "", 1.5, {"x": null}]', "{}", "[[1]]", "false"]
    df = spark.createDataFrame([(v,) for v in values], "j string").select(V.strings_of(F.parse_json("j")).alias("s"))
    assert [r.s for r in df.collect()] == [None, None, ["a"], None, None, ["b", "1.5", '{"x":null}'], ["{}"], ["[1]"], ["false"]]


def test_sections_of_any_depth(spark):
    def nested(n):
        return {"title": f"t{n}", "content": n, "subsections": [nested(n - 1)] if n else None}

    reports = [("a", {"sections": [nested(6), {"title": "plain"}]}), ("b", {}), ("c", {"sections": "none"})]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in reports], "k string, j string").select("k", F.parse_json("j").alias("v"))
    got = V.flattened(df, "k", "v").orderBy("path").collect()
    assert [(r.k, r.path, r.level, r.title, r.content) for r in got] == [("a", [0] * (7 - n), 7 - n, f"t{n}", str(n)) for n in range(6, -1, -1)] + [("a", [1], 1, "plain", None)]
    with pytest.raises(ValueError, match="nested"):
        V.flattened(df, "k", "v", most=3)


@pytest.mark.parametrize("gram", [1, 2, 3, 50])
def test_containing_names(spark, gram):
    r = random.Random(gram)
    names = ["".join(r.choice("abc가") for _ in range(r.randrange(12))) for _ in range(120)] + [None, ""]
    items = ["".join(r.choice("abc가") for _ in range(r.randrange(7))) for _ in range(150)] + [None, "", "  ", "zzzz"]
    got = {r.item: r.name for r in notes.containing_names(spark.createDataFrame([(x,) for x in items], "item string"), spark.createDataFrame([(x,) for x in names], "name string"), "item", "name", gram).collect()}
    want = {i: min(n for n in names if n and i in n) for i in items if i and i.strip() and any(n and i in n for n in names)}
    assert got == want


def test_containment_without_a_nested_loop(spark):
    many = spark.range(20_000).select(F.concat(F.lit("name "), F.sha1(F.col("id").cast("string"))).alias("name"))
    items = many.select(F.substring("name", 9, 12).alias("item"))
    found = notes.containing_names(items, many, "item", "name")
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == items.distinct().count()


def test_chains(spark):
    r = random.Random(4)
    edges = list({(r.randrange(8), r.randrange(8), r.choice("xyz")) for _ in range(60)})
    df = spark.createDataFrame(edges + edges[:5], "src_id int, dst_id int, rel_type string")

    def step(pattern):
        back, kinds = pattern.startswith("<"), pattern.strip("<>").split("|")
        return [((d, s) if back else (s, d), (s, d, k)) for s, d, k in edges if k in kinds]

    for pattern in (["x>"], ["x>", "<y"], ["x>", "x>", "<x"], ["z|x>", "<x|y", "y>"]):
        want = [((a, b), [e]) for (a, b), e in step(pattern[0])]
        for p in pattern[1:]:
            want = [((*n, b), [*used, e]) for n, used in want for (a, b), e in step(p) if a == n[-1] and e not in used]
        assert sorted(tuple(x) for x in graph.chains(df, pattern).collect()) == sorted(n for n, _ in want)
    assert graph.chains(df, ["none>", "x>"]).count() == 0
    for bad in ("x", ">", "<x>", "x||y>"):
        with pytest.raises(ValueError):
            graph.chains(df, [bad])


def test_units(spark):
    rows = [
        # fragment, table, row, col, column, text, head
        ("f", 0, -1, 0, "", "(단위: 주, 천원; 백만원)", True), ("f", 0, 1, 0, "과목", "a", False), ("f", 0, 1, 1, "당기", "5", False), ("f", 0, 2, 0, "과목", "b (단위: USD)", False), ("f", 0, 2, 1, "당기", "7", False),
        ("f", 2, 1, 0, "과목", "c", False), ("f", 2, 1, 1, "이익율", "9", False), ("f", 2, 1, 2, "당기", "3", False),
        ("f", 3, 1, 0, "과목", None, False), ("f", 3, 1, 1, "당기", "3", False),
        ("g", 0, 1, 1, "당기", "(단위: 억원)", False), ("g", 0, 2, 1, "당기", "x", False),
    ]
    df = spark.createDataFrame(rows, "fragment string, table_index int, row_index int, col_index int, column_name string, text string, is_head boolean")
    out = units.resolved_units(df)
    got = {(r.fragment, r.table_index, r.row_index, r.col_index): (r.unit and (r.unit.unit, r.unit.type, r.unit.source), r.unit_inherited, r.needs_unit) for r in out.collect()}
    assert got["f", 0, 1, 1] == (("천원", "money", "table"), False, True) and got["f", 0, 2, 1][0] == ("USD", "money", "row")
    assert got["f", 2, 1, 1] == (("%", "percent", "column"), True, True) and got["f", 2, 1, 2] == (("천원", "money", "inherited"), True, True)
    assert got["f", 3, 1, 1][:2] == (None, False)  # a unit goes on to the next table alone
    assert got["g", 0, 2, 1] == (("억원", "money", "table"), False, False) and got["g", 0, 1, 1][0][2] == "row"
    assert units.resolved_units(df)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    value = out.where("fragment = 'f' and col_index > 0").select("table_index", "row_index", "col_index", units.in_whole_units(F.col("text").try_cast("double"), F.col("unit")).alias("v"))
    assert {tuple(r) for r in value.collect()} == {(0, 1, 1, 5000), (0, 2, 1, 7), (2, 1, 1, 9), (2, 1, 2, 3000), (3, 1, 1, 3)}


def test_templates(spark):
    facts = spark.createDataFrame([("a", "R", 1, 10.0), ("a", "R", 2, 15.0), ("b", "R", 1, 5.0), ("b", "R", 2, 5.0), ("it's", "N", 2, 1.0)], "item_name string, section_code string, year int, value double")
    with pytest.raises(ValueError, match="year2"):
        templates.run(spark, "growth", {"facts": facts}, year1=1)
    with pytest.raises(ValueError, match="unknown"):
        templates.run(spark, "growth", {"facts": facts}, year1=1, year2=2, limit=3)
    with pytest.raises(ValueError, match="tables"):
        templates.run(spark, "growth", {}, year1=1, year2=2)
    with pytest.raises(ValueError, match="no template"):
        templates.run(spark, "none", {})
    got = templates.run(spark, "growth", {"facts": facts}, year1=1, year2=2).collect()
    assert [(r.item_name, r.growth) for r in got] == [("a", 50.0)]
    # Values are bound: quotes in them are text, not SQL.
    assert templates.run(spark, "ranking", {"facts": facts}, year=2, section="N' OR '1'='1").count() == 0
    assert templates.run(spark, "history", {"facts": facts}, pattern="it's", least=1).first().history == "2=1.0"
    assert templates.run(spark, "sections", {"facts": facts}, one="R", other="N").count() == 0
    assert set(templates.of_group("temporal")) == {"growth", "history", "ranking"} and templates.of_group("none") == {}
