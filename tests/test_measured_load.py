"""A load makes the statement values once, whatever comes of them."""

import pytest

from brightledger.plans import load_queries as Q


@pytest.mark.parametrize("query", [Q.measured_load, Q.run_summary])
def test_values_are_made_once(spark, monkeypatch, query):
    def scans(df):
        return "lineitem.parquet" in df._jdf.queryExecution().executedPlan().toString()

    frame, read = type(spark.range(1)), []
    real = frame.write.fget

    def seen(df):
        read.append(scans(df))
        return real(df)

    monkeypatch.setattr(frame, "write", property(seen))
    query(spark, "/root/testdata/sf0.001").collect()
    assert read.count(True) == 1 and len(read) > 4
