"""Chains and paths of any length, stores of several tables, cells inside other tags, and scores with tables."""

import pytest

from brightledger.functions import text as T
from brightledger.operators import hierarchy, notes, reports, statement_tables
from brightledger.sources import store as S
from brightledger.streaming.upsert_stream import upsert_batch


def test_descendants_of_a_long_chain_a_cycle_and_a_diamond(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(20)] + [("a", "b"), ("b", "a")] + [("t", "l"), ("t", "r"), ("l", "x"), ("r", "x")]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = hierarchy.descendants(df, spark.createDataFrame([("n0",), ("a",), ("t",)], "root string"))
    rows = {(r.root, r.node): r.depth for r in got.collect()}
    assert len(rows) == got.count() == 20 + 2 + 3
    assert rows["n0", "n20"] == 20 and rows["a", "a"] == 2 and rows["t", "x"] == 2


def test_paths_of_any_length(spark):
    path = ">".join(f"p{i}" for i in range(20))
    got = hierarchy.path_rollup(spark.createDataFrame([(path, 1.0)], "category_path string, value double"))
    assert got.count() == 20 and got.where("depth = 20").first().prefix == path


def test_names_in_blocks(spark):
    items = spark.createDataFrame([("an",), ("zz",)], "item string")
    names = spark.createDataFrame([("banana",), ("can",), ("plan",)], "name string")
    for block in (1, 2, 100):
        assert [tuple(r) for r in notes.containing_names(items, names, "item", "name", block).collect()] == [("an", "banana")]


def test_a_store_keeps_tables_that_a_load_does_not_touch(spark, tmp_path):
    store = S.Store(spark, f"file://{tmp_path}/store")

    def frame(*rows):
        return spark.createDataFrame(list(rows), "id string, seq int")

    upsert_batch(store, "nodes", frame(("a", 1)), "id", "seq")
    upsert_batch(store, "edges", frame(("e", 1)), "id", "seq")
    upsert_batch(store, "nodes", frame(("c", 1), ("a", 2)), "id", "seq")
    assert sorted(map(tuple, store.read("nodes").collect())) == [("a", 2), ("c", 1)]
    assert [r.id for r in store.read("edges").collect()] == ["e"] and [r.id for r in store.read("nodes", 1).collect()] == ["a"]
    with pytest.raises(ValueError, match="confirm"):
        store.write({"nodes": frame(("z", 1))}, replace=True)
    store.write({"nodes": frame(("z", 1))}, replace=True, confirm=True)
    assert not store.has("edges") and len(store.versions()) == 1 and store.read("nodes").first().id == "z"


def test_statement_index_and_classified_notes(spark, tmp_path):
    rows = [("f", 3, "PL", 1), ("f", 3, "CI", 2), ("f", 4, "PL", 1)]
    S.write_statement_index(spark.createDataFrame(rows, "file string, table_index int, section_code string, seq int"), f"{tmp_path}/index")
    got = sorted(map(tuple, S.read_statement_index(spark, f"{tmp_path}/index").collect()))
    assert got == [("f", 3, "CI"), ("f", 4, "PL")] and S.read_statement_index(spark, f"{tmp_path}/none").count() == 0
    classified = spark.createDataFrame([(2020, 1, "tax"), (2021, 2, "debt")], "year int, note_number int, category string")
    S.write_classified_notes(classified, classified.groupBy("category").count(), f"{tmp_path}/notes")
    assert spark.read.json(f"{tmp_path}/notes/notes").where("year = 2020").first().category == "tax"


CELLS = """<h2>Title</h2><table><tr><td><p>a</p></td><td rowspan="2"><div><p>b</p><p>c</p></div></td><tr><td>d<table><tr><th>n1</th></tr></table>e</td>
<td colspan="2">f</td><td>g</td></tr></table><p>text</p><table><td>h</table>"""


def test_cells_inside_other_tags(spark):
    got = reports.blocks(spark.createDataFrame([(1, CELLS)], "page_id long, html string")).orderBy("pos").collect()
    places = {r.text: (r.table_index, r.row_index, r.col_index) for r in got}
    assert places["a"] == (0, 0, 0) and places["b"] == places["c"] == (0, 0, 1)
    assert places["d"] == places["e"] == (0, 1, 0) and places["n1"] == (1, 0, 0)
    assert places["f"] == (0, 1, 2) and places["g"] == (0, 1, 4)
    assert places["Title"] == places["text"] == (None, None, None) and places["h"][0] == 2


def test_score_weighs_tables(spark):
    sections = spark.createDataFrame([(1, 1, "t", "x" * 60), (2, 1, "t", "x" * 60)], "page_id long, section_index int, title string, content string")
    tables = spark.createDataFrame([(1, "valid"), (1, "empty")], "page_id long, status string")
    got = {r.page_id: round(r.score, 6) for r in reports.report_validation(sections, tables, 2).collect()}
    assert got == {1: 0.55, 2: 0.7}


def test_labels_and_buckets(spark):
    row = spark.createDataFrame([("매출 Ⅱ 원가", "자산과 자본 및 손익")], "a string, b string").select(T.clean_label("a").alias("a"), T.item_buckets("b").alias("b")).first()
    assert row.a == "매출 원가" and row.b == ["assets", "equity", "profit"]


def test_tables_that_look_financial(spark):
    rows = [(1, "금액", "x"), (2, "c", "매출 1"), (3, "c", "word"), (3, "c", None), (4, "c", "1,000"), (4, "c", "word")]
    got = dict(map(tuple, statement_tables.looks_financial(spark.createDataFrame(rows, "table_id int, column_name string, text string")).collect()))
    assert got == {1: True, 2: True, 3: False, 4: True}
