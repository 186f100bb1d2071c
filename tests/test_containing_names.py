"""Containment goes by pieces of the lengths that items have."""

from brightledger.operators import notes


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pieces_of_names_are_not_broadcast_and_items_are_pieces(spark):
    names = spark.range(3000).selectExpr("concat('Customer#', lpad(id, 9, '0')) AS name")
    items = spark.createDataFrame([("#00000001",), ("00000299",), ("Customer#000000007",), ("x",)], "item string")
    got = notes.containing_names(items, names, "item", "name")
    assert sorted(map(tuple, got.collect())) == [("#00000001", "Customer#000000010"), ("00000299", "Customer#000000299"), ("Customer#000000007", "Customer#000000007")]
    assert "BroadcastHashJoin" not in plan(got)
