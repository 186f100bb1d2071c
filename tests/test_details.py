"""Drawings, limits, buckets, percentages and the load of reports on odd rows."""

from pyspark.sql import functions as F

from brightledger.functions import text as T
from brightledger.operators import graph, relations
from brightledger.plans.report_load import report_tables


def test_elements_of_a_drawing(spark):
    rows = [("a", "x", 2020, None, 1.0), ("a", "x", 2020, "current", 2.0), (None, "y", None, None, None), ("", None, 2021, None, 3.0)]
    nodes, edges = graph.graph_elements(spark.createDataFrame(rows, "company string, item_name string, year int, period string, value double"))
    got = {r.id: r.label for r in nodes.collect()}
    assert got == {"company:a": "a", "item:x": "x", "year:2020": "Y:2020", "period:current": "P:current", "value:a:x:2020": "V:1.0", "item:y": "y", "year:2021": "Y:2021", "value:None:None:2021": "V:3.0"}
    assert sorted(map(tuple, edges.collect())) == [
        ("company:a", "item:x", "has_data"), ("item:x", "value:a:x:2020", "value"), ("item:x", "year:2020", "in_year"), ("year:2020", "period:current", "period"),
    ]
    bare = graph.graph_elements(spark.createDataFrame([("a",)], "company string"))
    assert bare[0].count() == 1 and bare[1].count() == 0


def test_limited(spark):
    df = spark.range(300).select("id", F.when(F.col("id") < 290, "many").when(F.col("id") < 298, "few").alias("kind"))
    got = graph.limited(df, "kind", ["id"], {"many": 3, "few": 100}, default=1).collect()
    assert sorted((str(r.kind), r.id) for r in got) == sorted([("many", 0), ("many", 1), ("many", 2), *(("few", i) for i in range(290, 298)), ("None", 298)])


def test_buckets_percentages_auditors(spark):
    df = spark.createDataFrame([("subsidiary", "5 %", "삼정 Kpmg"), (None, None, None), ("특수관계기업", "abc", "딜로이트 안진회계법인"), ("joint_venture", "", "ey한영회계법인")], "k string, p string, a string")
    got = [tuple(r) for r in df.select(T.initial_bucket("k"), T.loose_percentage("p"), T.auditor("a")).collect()]
    assert got == [("subsidiaries", 5.0, "삼정KPMG"), ("special_relations", None, None), ("special_relations", None, "딜로이트안진회계법인"), ("joint_ventures", None, "EY한영회계법인")]


def test_companies_do_not_depend_on_partitions(spark):
    rows = [("a", float(p), k, 1) for p, k in ((30, "x"), (60, "y"), (10, "z"))]
    df = spark.createDataFrame(rows, "name string, percent double, kind string, seq int")
    got = {tuple(relations.companies(df.repartition(n).orderBy(F.desc("percent") if n % 2 else F.asc("percent")), "name", "percent", "kind", "seq").first()) for n in (1, 2, 3, 4)}
    assert got == {("a", 10.0, "z", "SPECIAL_RELATION")}


def test_reports_without_much(spark):
    page = '<h2 class="SECTION-1">감사의견</h2><p>적정의견</p>'  # too short to count
    long = '<h2 class="SECTION-1">감사의견</h2><p>' + "x " * 60 + "삼정 kpmg 2020.1.2</p>"
    rows = [(1, "c", 2020, None), (2, "c", 2020, ""), (3, "c", 2021, page), (4, "d", 2021, long), (5, "d", 2021, long.replace("2020", "2019")), (6, None, 2021, long)]
    made = report_tables(spark.createDataFrame(rows, "page_id long, company string, year int, html string"))
    audits = [(r.company, r.year, r.auditor, r.audit_date) for r in made["audits"].where("company is not null").collect()]
    assert audits == [("d", 2021, "삼정KPMG", "2020-01-02")]  # the first report's, field by field
    assert made["notes"].count() == 0 and made["sections"].count() == 4
    kinds = {r.rel_type for r in made["edges"].collect()}
    assert kinds == {"has_audit_info", "audited_by", "related_to"}
    empty = report_tables(spark.createDataFrame([], "page_id long, company string, year int, html string"))
    assert all(t.count() == 0 for t in empty.values())
