"""Many rows of runs are merged with the base in one shuffle, and merged runs are not merged again."""

import pytest

from brightledger.plans import merge_queries
from brightledger.sources import merge_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rule", ["first", "last"])
def test_base_and_runs_are_shuffled_once(spark, tmp_path, monkeypatch, rule):
    made = merge_table.MergeTable(spark, f"file://{tmp_path}/t", rule=rule, buckets=2, fanout=2)
    for i in range(2):
        made.upsert(spark.range(40).selectExpr("id % 20 AS id", f"id + {i} AS seq", f"if(id % 3 = {i}, null, id) AS v"))
    assert "Exchange" not in plan(made.read()) and made.read().count() == 20
    made.compact()
    made.upsert(spark.range(10, 30).selectExpr("id", "id AS seq", "id * 2 AS v"))
    want = sorted(map(tuple, made.read().collect()))
    monkeypatch.setattr(merge_table, "BROADCAST_ROWS", 0)
    got = made.read()
    assert "Join" not in plan(got) and plan(got).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, got.collect())) == want and len(want) == 30


def test_edges_are_joined_once_for_all_batches(spark, monkeypatch):
    runs = []
    real = merge_table.MergeTable._write_run

    def seen(self, rows, level):
        runs.append(plan(rows))
        return real(self, rows, level)

    monkeypatch.setattr(merge_table.MergeTable, "_write_run", seen)
    merge_queries.merged_edges(spark, "/root/testdata/sf0.001").count()
    assert len(runs) > 4 and not any("lineitem.parquet" in p for p in runs)
