"""Stores, the whole load, and the stream of upserts."""

from functools import reduce

import pytest
from pyspark.sql import DataFrame

from brightledger.operators import upsert
from brightledger.plans.statement_pipeline import run_pipeline
from brightledger.sources import store as S
from brightledger.streaming.upsert_stream import upsert_stream

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_twice_is_once(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    first = {r.table: r.n for r in run_pipeline(spark, FOLDER, path).collect()}
    assert first["data"] > 0 and first["edges"] > 0
    assert {r.table: r.n for r in run_pipeline(spark, FOLDER, path).collect()} == first
    assert {"notes", "note_edges", "categories", "category_edges", "audits", "relations", "related_companies", "search_documents", "search_edges"} <= {t for t, n in first.items() if n}
    store = S.Store(spark, path)
    assert store.versions() == [1, 2]
    nodes = reduce(DataFrame.union, [store.read(t).select("id") for t in ("companies", "sections", "years", "data", "categories", "notes", "note_categories", "audits", "auditors", "search_documents")])
    assert nodes.count() == nodes.distinct().count()
    for t in ("edges", "category_edges", "note_edges", "audit_edges", "search_edges"):
        for end in ("src_id", "dst_id"):
            assert upsert.dangling_edges(store.read(t), nodes, end).isEmpty(), (t, end)
    assert {r.trend_type for r in store.read("trends").select("trend_type").distinct().collect()} == {"year_over_year", "overall", "recent"}
    assert store.read("edges", 1).exceptAll(store.read("edges", 2)).isEmpty()
    with pytest.raises(ValueError, match="confirm"):
        store.write({}, replace=True)


def test_reports_round_trip(spark, tmp_path):
    schema = "name string, year int, sections array<struct<title: string, content: string, subsections: array<struct<title: string, content: string>>>>"
    df = spark.createDataFrame([("a", 2020, [("t", "c", [("u", "d")])]), ("b", 2021, [])], schema)
    S.write_reports(df, f"{tmp_path}/reports")
    back = S.parsed_reports(spark, f"{tmp_path}/reports", schema, [2020])
    assert [r.name for r in back.collect()] == ["a"]
    flat = S.flattened_sections(back, "name").orderBy("seq").collect()
    assert [(r.seq, r.level, r.title) for r in flat] == [(0, 1, "t"), (1, 2, "u")]
    assert S.or_empty(spark, f"{tmp_path}/none", "a int").count() == 0


def test_backup(spark, tmp_path):
    df = spark.range(5)
    S.backup({"n": df}, f"{tmp_path}/b")
    assert S.restored(spark, f"{tmp_path}/b", ["n"])["n"].count() == 5


def test_report_year(spark):
    df = spark.createDataFrame([(2019, "x_2020.htm"), (None, "x_2021.htm"), (None, "x.htm")], "declared int, name string")
    assert [r.report_year for r in S.report_year(df, "declared", "name").collect()] == [2019, 2021, 2014]


def test_raw_reports(spark, tmp_path):
    (tmp_path / "r_2017.htm").write_bytes("가".encode("euc-kr"))
    assert [(r.year, bytes(r.content)) for r in S.raw_reports(spark, f"{tmp_path}/*.htm").collect()] == [(2017, "가".encode("euc-kr"))]


def test_stream_of_upserts(spark, tmp_path):
    schema = "id long, seq long, v string"
    for i, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(2, 2, "c")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = upsert_stream(spark, f"{tmp_path}/in", schema, f"file://{tmp_path}/store", "nodes", f"{tmp_path}/cp")
        q.awaitTermination(60)
        assert q.exception() is None
    got = S.Store(spark, f"file://{tmp_path}/store").read("nodes").orderBy("id").collect()
    assert [(r.id, r.v) for r in got] == [(1, "a"), (2, "c")]
