"""Measured writes and tables kept by year."""

import json

from pyspark.sql import functions as F

from brightledger.operators import upsert
from brightledger.operators.metrics import RunMetrics
from brightledger.plans.statement_pipeline import run_pipeline
from brightledger.sources import tables, yearly

FOLDER = "/root/testdata/sf0.001"


def test_steps_are_measured(spark, tmp_path):
    metrics = RunMetrics(spark)
    edges = spark.createDataFrame([("a", "b", "x"), ("a", "b", "x"), ("a", "z", "x"), ("a", "b", "y")], "src_id string, dst_id string, rel_type string")
    ends = spark.createDataFrame([("a",), ("b",)], "id string")
    made = upsert.existing_edges(edges, ends, ends, attempted=lambda df: metrics.attempted("edges", df, "rel_type", ("x", "y", "none")))
    metrics.measured("edges", made, lambda df: df.write.parquet(f"{tmp_path}/edges"))
    metrics.measured("nodes", ends, lambda df: df.write.parquet(f"{tmp_path}/nodes"))
    metrics.measured("empty", ends.where("false"), lambda df: df.write.parquet(f"{tmp_path}/empty"))
    got = {(r.operation, r.kind): r for r in metrics.frame().collect()}
    assert [(r.total_items, r.processed_items, r.failed_items, r.success_rate) for k in ("x", "y", "none") for r in [got["edges", k]]] == [(2, 1, 1, 50.0), (1, 1, 0, 100.0), (0, 0, 0, 0.0)]
    assert got["nodes", None].processed_items == 2 and got["empty", None].success_rate == 0.0
    assert all(r.duration_seconds > 0 and (r.throughput_per_second > 0) == (r.processed_items > 0) for r in got.values())
    s = metrics.summary().first()
    assert (s.operations_count, s.total_items, s.total_processed, s.overall_success_rate) == (3, 5, 4, 80.0)
    assert abs(s.total_duration_seconds - sum(got[k].duration_seconds for k in (("edges", "x"), ("nodes", None), ("empty", None)))) < 1e-9
    metrics.save(f"{tmp_path}/metrics")
    assert spark.read.json(f"{tmp_path}/metrics/operations").count() == 5
    assert RunMetrics(spark).summary().first().overall_success_rate == 0.0


def test_a_load_is_measured(spark, tmp_path):
    got = run_pipeline(spark, FOLDER, f"file://{tmp_path}/store", [1995, 1996]).collect()
    kinds = {r.kind: r for r in got if r.table == "edges"}
    assert set(kinds) == {"contains_data", "has_year_data", "has_financial_statement", "precedes"}
    data = next(r for r in got if r.table == "data")
    assert kinds["contains_data"].n == data.n > 0 and all(r.duration_seconds > 0 and r.failed_items == 0 for r in got)
    facts = tables.statements(spark, FOLDER).where("year in (1995, 1996)").count()
    assert data.n == facts == tables.statements(spark, FOLDER, [1995, 1996]).count()
    first = json.loads(spark.read.text(f"file://{tmp_path}/store/metrics/1/summary").first().value)
    assert first["total_processed"] == sum(r.n for r in got)


def test_years_reach_the_scan(spark):
    plan = tables.statement_rows(spark, FOLDER, [1995])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert tables.statement_rows(spark, FOLDER, []).count() == 0


def test_yearly_tables(spark, tmp_path):
    path = f"{tmp_path}/rows"
    rows = spark.range(300).select("id", (F.lit(2014) + F.col("id") % 5).cast("int").alias("year"))
    yearly.write_yearly(rows, path)
    assert yearly.read_yearly(spark, path).count() == 300
    some = yearly.read_yearly(spark, path, [2015, 2017, 1900])
    assert some.count() == 120 and {r.year for r in some.collect()} == {2015, 2017}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year#" in plan and "PushedFilters: []" in plan
    wanted = spark.createDataFrame([("x", 2016), ("y", 2016), ("z", 1900)], "name string, year int").where("name <> 'q'").select("year")
    joined = yearly.read_yearly(spark, path, wanted)
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 60
    yearly.write_yearly(rows.where("year = 2016").limit(5), path)  # replaces the year alone
    assert yearly.read_yearly(spark, path).count() == 245
    assert sorted(r.year for r in yearly.available_years(spark, path).collect()) == [2014, 2015, 2016, 2017, 2018]
