"""Sections, records and tables that are made where a page is read agree with those of its blocks, and no block is shuffled or written."""

import random

import pytest
from pyspark.sql import functions as F

from brightledger.operators import report_tree as R
from brightledger.operators import reports as B
from brightledger.operators.statement_tables import looks_financial, texts_financial
from brightledger.plans import store_queries as S
from brightledger.plans import tree_queries as Q

TAGS = (
    '<h2 class="SECTION-1">', '<h2 class="x SECTION-1 y">', "</h2>", '<h3 class="SECTION-2">', '<p class="SECTION-2">', '<td class="SECTION-2">', '<h4 class="SECTION-9">', "<p>", "</p>", "<table>", "</table>", "<tr>", "<td>", "</td>",
    "<br/>", "<b>", "</b>", "<title>", "</title>",
)
TEXTS = ("주석", "3. 주석", "1. One", " 07.x ", "99999999999. far", "2147483648. more", "외부감사 실시내용", "a", "a &amp; b", "&am", "p;", " ", "", "", "12", "(3)", "part", "\n x  y")
ODD = ("<", ">", "<!-- c -->", "<script>'<p>'</script>", "<p class=x>", "</p x>", "a < b > c")


def pages(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)

    def one(tags, odd):
        return "".join(t + rng.choice(TEXTS) + (rng.choice(ODD) if odd and rng.random() < 0.1 else "") for t in tags)

    made = []
    for i in range(n):
        tags = [rng.choice(TAGS) for _ in range(rng.randint(0, 30))]
        # The same tags come again with other texts, or with what is no plain page.
        made += [one(tags, False), one(tags, False), one(tags, False), one(tags, i % 2)]
    return made


def rows(shapes, html: str) -> list[tuple]:
    frame, texts = shapes.read(html)
    assert len(texts) == frame.n
    return [(i, tag, css, text, *place) for i, (text, tag, css, *place) in enumerate(zip(texts, *frame.columns))]


def test_pages_of_known_tags_are_read_as_parsed_ones(monkeypatch):
    monkeypatch.setattr(B, "SHAPES", 10**8)
    shapes, many = B.Shapes(), pages(1500, 1)
    for html in many + many[::-1]:
        parsed = B._Reader()
        parsed.feed(html)
        parsed.close()
        parsed.flush()
        assert rows(shapes, html) == parsed.rows, html
    assert sum(map(bool, shapes.known.values())) > 500


def test_a_worker_forgets_tags(monkeypatch):
    monkeypatch.setattr(B, "SHAPES", 1000)
    shapes = B.Shapes()
    for html in pages(400, 2):
        assert rows(shapes, html) == B._Reader().read(html)
        assert sum(map(len, shapes.known)) <= 1000


@pytest.fixture(scope="module")
def made(spark):
    rows = [(i, h, f"f_{2000 + i % 9}.htm" if i % 4 else "f.htm") for i, h in enumerate([None, "", *pages(150, 3)])]
    p = spark.createDataFrame(rows, "page_id long, html string, source_file string").repartition(3).localCheckpoint()
    return p, B.blocks(p).localCheckpoint()


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_sections_of_pages_are_those_of_blocks(made):
    p, blocks = made
    same(R.page_sections(p), R.section_tree(blocks))


def test_records_of_pages_are_those_of_blocks(made):
    p, blocks = made
    same(R.records(p), R.reports(p, R.section_tree(blocks), blocks))


def test_tables_of_pages_are_those_of_blocks(made):
    p, blocks = made
    shown, key = blocks.where("table_index is not null"), ["page_id", "table_index"]
    tables = B.table_status(shown, key).join(looks_financial(shown.withColumn("column_name", F.lit("")), ("part",), key), key).withColumnRenamed("financial", "is_financial")
    of_texts = F.transform("tables", lambda t: F.struct(B.texts_status(t).alias("status"), texts_financial(t, ("part",)).alias("is_financial")))
    got = R.validated_reports(R.records(p, tables=True).withColumn("tables", of_texts))
    want = R.validated_reports(R.reports(p, R.section_tree(blocks), blocks), tables)
    same(got.select(*sorted(got.columns)), want.select(*sorted(want.columns)))


def test_status_and_figures_of_texts(spark):
    lists = [["", " "], ["", "a"], ["", " ", "a"], [None, ""], [None], ["Part"], ["1", "a", "a", "a"], ["1", "a", "a", "a", "a"]]
    t = spark.createDataFrame(list(enumerate(lists)), "table_id int, texts array<string>")
    cells = t.select("table_id", F.explode("texts").alias("text"), F.lit("").alias("column_name"))
    want = B.table_status(cells, ["table_id"]).join(looks_financial(cells, ("part",)), "table_id")
    same(t.select("table_id", B.texts_status(F.col("texts")).alias("status"), texts_financial(F.col("texts"), ("part",)).alias("financial")), want)


def small(spark, folder):
    spark.createDataFrame([(i, i % 7, "O", "1996-01-02") for i in range(40)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i % 40, i, i % 5, i % 4 + 1, "A") for i in range(120)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    return f"file://{folder}"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [Q.report_records, Q.section_validation, Q.main_sections, Q.numbered_parts, S.planned_load, Q.nested_sections])
def test_blocks_do_not_leave_their_task(spark, tmp_path, query):
    d = small(spark, tmp_path)
    made, got = plan(Q.made_reports(spark, d)), plan(query(spark, d))
    assert "Window" not in got and got.count("Exchange hashpartitioning(page_id") == 0
    assert got.count("Exchange") == made.count("Exchange") + (query is S.planned_load)


@pytest.mark.parametrize("query", [Q.validated_reports, Q.report_lines])
def test_only_validations_are_written(spark, tmp_path, monkeypatch, query):
    d, kept = small(spark, tmp_path), []
    real = Q.written
    monkeypatch.setattr(Q, "written", lambda df: kept.append(df) or real(df))
    query(spark, d).collect()
    assert len(kept) == 1 and kept[0].count() == 40 and not {"text", "sections", "all_text", "tables"} & set(kept[0].columns)
    assert plan(kept[0]).count("Exchange") == plan(Q.made_reports(spark, d)).count("Exchange")
