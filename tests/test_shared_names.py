"""References and targets that share one name meet once for each reference."""

from brightledger.operators import notes


def test_a_shared_name_makes_no_pairs(spark):
    refs = spark.range(200).selectExpr("1 AS k", "'shared' AS clean", "concat('raw ', id) AS raw")
    targets = spark.range(300).selectExpr("1 AS k", "'shared' AS name", "concat('raw ', 2 * id) AS original", "1000 - id AS id")
    got = notes.matched_names(refs, targets, "k", "clean", "raw", "id", "name", "original")
    assert got.count() == 200 and {r.id for r in got.collect()} == {701}
    alone = notes.matched_names(refs, targets.selectExpr("k", "'other' AS name", "original", "id"), "k", "clean", "raw", "id", "name", "original")
    assert {r.raw: r.id for r in alone.collect()} == {f"raw {2 * i}": 1000 - i for i in range(100)}
    # The most rows that any step of the plan makes: references by clean and by raw name, no pairs of them and targets.
    made, nodes = [], [got._jdf.queryExecution().executedPlan()]
    got.collect()
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            nodes.append(node.plan())
        if "Join" in name:
            made.append(node.metrics().apply("numOutputRows").value())
        nodes.extend(node.children().apply(i) for i in range(node.children().size()))
    assert made and max(made) <= 200
