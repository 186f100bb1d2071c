"""Rows without a doc_id in the pipeline's dedup stages."""

import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
BODY = " ".join(f"word{i}" for i in range(200))


def left(spark, stage, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS).repartition(3)
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


@pytest.mark.parametrize("stage", [corpus_pipeline.exact_filter, corpus_pipeline.near_filter])
def test_copies_of_a_row_without_an_id(spark, stage):
    assert left(spark, stage, [(None, BODY), (7, BODY), (3, BODY), (None, BODY), (9, "of its own")]) == [(3, BODY), (9, "of its own")]


def test_only_rows_without_an_id(spark):
    assert left(spark, corpus_pipeline.exact_filter, [(None, "a  b"), (None, "a  b"), (None, "c")]) == [(None, "a  b"), (None, "c")]


def test_near_copy_without_an_id(spark):
    rows = [(None, BODY + " one"), (5, BODY + " two"), (None, "something else")]
    assert left(spark, corpus_pipeline.near_filter, rows) == [(5, BODY + " two"), (None, "something else")]
