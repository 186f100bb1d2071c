"""Registered queries on the smallest tables: against SQL where there is some, and held-out accuracy."""

import duckdb
import pytest

import corpus_pipeline
from brightledger.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, duck, name):
    rel = duck.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, FOLDER).select(*rel.columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, rel.fetchall()))


def test_all_of_them():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_quality_held_out(spark):
    folder = FOLDER.replace("0.001", "0.1")
    found = queries.queries()["op2_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows) > 100
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert docs.columns == columns
            ids = {r.doc_id for r in docs.collect()}
            assert before is None or ids <= before
            before = ids
    assert {r.doc_id for r in docs.collect()} == before
    texts = [" ".join(r.text.split()) for r in spark.read.parquet(f"{tmp_path}/exact_dedup").collect()]
    assert len(set(texts)) == len(texts)
    assert spark.read.parquet(f"{tmp_path}/quality").count() > 0.7 * 200


def test_pipeline_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, None), (None, "x y", "en", "s", 3), (3, "a b c " * 200, "en", "s", 9), (3, "a b c " * 200, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, FOLDER)
            assert out.count() <= max(1, df.count()) or name == "pack"
