"""Merge-on-read tables: what a batch costs, and that reads are those of one upsert over everything."""

import os
import random

import pytest

from brightledger.operators.upsert import first_filled, last_wins
from brightledger.sources.merge_table import MergeTable
from brightledger.sources.store import Store

SCHEMA = "id string, seq long, a string, b double"


def batches(n, size, seed=1):
    """Rows of few keys, late ones and repeated ones among them, with nulls."""
    r = random.Random(seed)
    return [[(f"k{r.randrange(30)}", r.randrange(40), r.choice([None, "x", "y", f"v{i}"]), r.choice([None, 1.5, float(i)])) for _ in range(size)] for i in range(n)]


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "seq", "a", "b").collect()), key=repr)


def test_last_wins_over_everything(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", buckets=4, fanout=3)
    every = []
    for i, batch in enumerate(batches(9, 12)):
        table.upsert(spark.createDataFrame(batch, SCHEMA))
        every += [(*row, i) for row in batch]
        if i in (3, 6):
            table.compact()
        if i in (2, 3, 5, 6, 8):
            both = spark.createDataFrame(every, SCHEMA + ", n long").selectExpr("id", "struct(seq, n) AS seq", "a", "b")
            want = last_wins(both.limit(0), both, "id", "seq").selectExpr("id", "seq.seq", "a", "b")
            assert rows(table.read()) == rows(want)
    assert max(r["level"] for r in table.manifest()["runs"]) == 0 and len(table.manifest()["runs"]) == 2
    assert set(table.read().columns) == {"id", "seq", "a", "b"}


def test_first_filled_over_everything(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", rule="first", buckets=4, fanout=2)
    every = []
    for i, batch in enumerate(batches(7, 12, 2)):
        table.upsert(spark.createDataFrame(batch, SCHEMA))
        every += [(i * 1000 + row[1], *row) for row in batch]
        if i == 4:
            table.compact()
    want = first_filled(spark.createDataFrame(every, "seq long, id string, own long, a string, b double"), ["id"], ["a", "b"])
    got = sorted((tuple(r) for r in table.read().select("id", "a", "b").collect()), key=repr)
    assert got == sorted((tuple(r) for r in want.collect()), key=repr)


def test_a_batch_costs_its_own_size(spark, tmp_path):
    """A run of few rows is written for a batch of few rows, however large the table is, and its base is not touched."""
    table = MergeTable(spark, f"file://{tmp_path}/t", keys=["id"], buckets=4)
    table.upsert(spark.range(200_000).selectExpr("uuid() AS id", "id AS seq", "repeat('x', 20) AS a", "rand() AS b"))
    table.compact()
    large = size(tmp_path / "t" / "base")
    before = size(tmp_path)
    assert large > 5_000_000
    for i in range(3):
        table.upsert(spark.createDataFrame([(f"new{i}-{j}", 1, "y", 0.5) for j in range(50)], SCHEMA).coalesce(1))
    assert size(tmp_path) - before < 30_000 and size(tmp_path / "t" / "base") == large
    # The base goes through a read without a shuffle: only what has newer versions is combined.
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert table.read().count() == 200_150
    found = table.lookup(spark.createDataFrame([("new1-7",), ("none",)], "id string"))
    assert [r.id for r in found.collect()] == ["new1-7"]
    table.compact()
    assert len(table.manifest()["base"]) == 4 and table.read().count() == 200_150
    read = [f for f in table.lookup(spark.createDataFrame([("new1-7",)], "id string")).inputFiles()]
    assert len({f.rpartition("/")[0] for f in read}) == 1  # one bucket of four


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", buckets=8)
    table.upsert(spark.range(500).selectExpr("CAST(id AS STRING) AS id", "id AS seq"))
    table.compact()
    first = table.manifest()["base"]
    table.upsert(spark.createDataFrame([("7", 900)], "id string, seq long"))
    table.compact()
    second = table.manifest()["base"]
    assert sum(first[b] != second[b] for b in first) == 1 and set(first) == set(second)
    assert table.read().where("id = '7'").first().seq == 900
    table.compact(buckets=2)
    assert len(table.manifest()["base"]) == 2 and table.read().count() == 500
    assert table.vacuum() > 0
    assert table.read().count() == 500 and len(table.versions()) == 1 and not os.listdir(tmp_path / "t" / "run")


def test_new_columns_odd_keys_and_empty_batches(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", keys=["src", "dst"], buckets=2, fanout=2)
    table.upsert(spark.createDataFrame([], "src string, dst string, seq long"))
    with pytest.raises(ValueError, match="nothing"):
        table.read()
    table.upsert(spark.createDataFrame([("a", "b", 1), (None, "b", 2), ("a", None, 2)], "src string, dst string, seq long"))
    table.compact()
    table.upsert(spark.createDataFrame([("c", "d", 1, "kind")], "src string, dst string, seq long, label string"))
    got = sorted((r.src, r.dst, r.label) for r in table.read().collect())
    assert got == [("a", "b", None), ("c", "d", "kind")]
    table.upsert(spark.createDataFrame([("a", "b", 0, "late")], "src string, dst string, seq long, label string"))
    assert table.read().where("src = 'a'").first().label is None  # an earlier row does not win
    table.compact()
    assert sorted((r.src, r.dst, r.label) for r in table.read().collect()) == got
    assert table.lookup(spark.createDataFrame([("zz", "q")], "src string, dst string")).count() == 0


def test_tokens_versions_and_writers(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t")
    one = table.upsert(spark.createDataFrame([("a", 1, "x", 0.0)], SCHEMA), ("stream", 0))
    assert table.upsert(spark.createDataFrame([("b", 1, "x", 0.0)], SCHEMA), ("stream", 0)) == one and table.read().count() == 1
    two = table.upsert(spark.createDataFrame([("b", 1, "x", 0.0)], SCHEMA), ("stream", 1))
    assert table.read(one).count() == 1 and table.read(two).count() == 2
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(table.manifest(), one)
    again = MergeTable.open(spark, f"file://{tmp_path}/t")
    assert again.keys == ["id"] and again.read().count() == 2
    with pytest.raises(ValueError):
        MergeTable(spark, "x", rule="any")


def test_a_store_takes_over_a_written_table(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.write({"nodes": spark.createDataFrame([("a", 1, "old", 0.0), ("b", 1, "old", 0.0)], SCHEMA)})
    store.upsert("nodes", spark.createDataFrame([("b", 2, "new", 0.0)], SCHEMA), ["id"])
    store.upsert("nodes", spark.createDataFrame([("c", 2, "new", 0.0)], SCHEMA), ["id"])
    assert {r.id: r.a for r in store.read("nodes").collect()} == {"a": "old", "b": "new", "c": "new"}
    assert store.read("nodes", 1).count() == 2 and store.read("nodes", 2).count() == 2 and store.versions() == [1, 2, 3]
    store.write({"nodes": spark.createDataFrame([("z", 1, "whole", 0.0)], SCHEMA)})
    store.upsert("nodes", spark.createDataFrame([("y", 1, "more", 0.0)], SCHEMA), ["id"])
    assert {r.id for r in store.read("nodes").collect()} == {"z", "y"} and store.read("nodes", 3).count() == 3
