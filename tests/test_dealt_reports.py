"""Pages are dealt before they are read, read once and in small batches, and read alike however they are cut."""

import random

from brightledger.operators import report_tree as R
from brightledger.operators import reports as B
from brightledger.plans import tree_queries as Q

PIECES = (
    "<p>", "</p>", '<P class="SECTION-2">', "<h2 class='SECTION-1 x'>", "</h2>", "<table>", "</table>", "<tr>", "<td colspan=\"2\">", '<td rowspan="3">', "</td>", "<th>", "<thead>", "<br/>", "<p/>", "<p class=x>", "a &amp; b", "&#44", " ", "1. x", "<", ">",
    "<!-- <p> -->", "<script>a='<p>'</script>", "</div >", '<p class="a" class="b">', '<a href="u?a=1&b=2">', "</p x>", "<title>T</title>",
)


def test_cut_pages_are_read_as_parsed_ones():
    rng = random.Random(3)
    for i in range(4000):
        html = "".join(rng.choice(PIECES[:20] if i % 2 else PIECES) for _ in range(rng.randint(0, 25)))
        parsed = B._Reader()
        parsed.feed(html)
        parsed.close()
        parsed.flush()
        assert B._Reader().read(html) == parsed.rows, html


def small(spark, folder):
    spark.createDataFrame([(i, i % 7, "O", "1996-01-02") for i in range(40)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i % 40, i, i % 5, i % 4 + 1, "A") for i in range(120)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    return f"file://{folder}"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_files_are_dealt_before_pages_are_made(spark, tmp_path):
    assert "BroadcastHashJoin" not in plan(Q.main_sections(spark, small(spark, tmp_path)))


def test_records_read_pages_once_and_agree_with_those_of_a_tree(spark, tmp_path):
    d = small(spark, tmp_path)
    pages = Q.made_reports(spark, d)
    blocks = B.blocks(pages)
    got = Q.made_records(spark, d)
    assert plan(got).count("MapInArrow") == 1
    of_tree = R.reports(pages, R.section_tree(blocks), blocks)
    assert sorted(map(str, got.collect())) == sorted(map(str, of_tree.collect()))
    assert plan(Q._validated(spark, d)).count("MapInArrow") == 0
