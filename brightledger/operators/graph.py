"""Checks and figures of node and edge tables. Issues are rows: severity, category, message, n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def label_counts(nodes: DataFrame, label: str = "label") -> DataFrame:
    """Nodes per label, and their total."""
    return nodes.rollup(label).agg(F.count(F.lit(1)).alias("n")).withColumn(label, F.coalesce(label, F.lit("TOTAL")))


def duplicate_ids(nodes: DataFrame, node_id: str = "id", label: str = "label", most: int | None = 10) -> DataFrame:
    """Ids that occur more than once, with their labels."""
    labels = F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels")
    out = nodes.groupBy(node_id).agg(F.count(F.lit(1)).alias("n"), labels).where("n > 1")
    return out if most is None else out.orderBy(F.desc("n"), node_id).limit(most)


def orphans(nodes: DataFrame, edges: DataFrame, node_id: str = "id", src: str = "src_id", dst: str = "dst_id") -> DataFrame:
    """Nodes without any edge."""
    ends = edges.select(F.col(src).alias(node_id)).unionByName(edges.select(F.col(dst).alias(node_id))).distinct()
    return nodes.join(ends, node_id, "left_anti")


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``(property, n)``: missing values of required columns, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], list(required), "property", "n")


def value_quality(df: DataFrame, value: str, year: str, name: str, first: int = 2000, last: int = 2030) -> DataFrame:
    """``(check, n)``: values that are no numbers, years out of range, names missing."""
    checks = {
        "bad_value": ~F.coalesce(F.col(value).rlike(r"^-?[0-9]+\.?[0-9]*$"), F.lit(False)),
        "bad_year": ~F.coalesce(F.col(year).between(first, last), F.lit(False)),
        "no_name": F.coalesce(F.trim(name) == "", F.lit(True)),
    }
    return df.agg(*[F.count_if(c).alias(k) for k, c in checks.items()]).unpivot([], list(checks), "check", "n")


def coverage(expected: DataFrame, found: DataFrame, on: str, enough: int) -> DataFrame:
    """An issue for each expected key with nothing (critical) or little (warning)."""
    counts = found.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    joined = expected.select(on).distinct().join(counts, on, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.withColumn("severity", F.when(F.col("n") == 0, "critical").when(F.col("n") < enough, "warning")).where("severity is not null")


def severity_summary(issues: DataFrame) -> DataFrame:
    """Issues by severity, and whether the store passes (nothing critical)."""
    return issues.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).withColumn("passes", F.col("severity") != "critical")


def samples(nodes: DataFrame, label: str, node_id: str, k: int = 3) -> DataFrame:
    """The first ``k`` nodes of each label by id."""
    ranked = nodes.withColumn("rank", F.row_number().over(W.partitionBy(label).orderBy(node_id)))
    return ranked.where(F.col("rank") <= k)


def chains(edges: DataFrame, steps: Sequence[str], src: str = "src_id", dst: str = "dst_id", kind: str = "rel_type") -> DataFrame:
    """``n0, n1, ..., nk``: every chain of nodes that a pattern of typed edges allows.

    A step is ``type>`` (from a node to the next) or ``<type`` (from the next node back), or several types with ``|`` between. The
    joins begin with the step that fewest edges fit and go on to the smaller neighbour of what is joined, so the hubs of a
    large type meet only nodes that are in a chain already. An edge is used once in a chain, as in a graph pattern.
    """
    parsed = []
    for step in steps:
        back, types = step.startswith("<"), step.strip("<>").split("|")
        if step.endswith(">") == back or not all(types):
            raise ValueError(f"a step is 'type>' or '<type', not {step!r}")
        parsed.append((back, types))
    edges = edges.select(src, dst, kind).distinct()
    # A row for each type.
    counts = {r[0]: r[1] for r in edges.groupBy(kind).count().collect()}

    def fitting(i: int) -> DataFrame:
        back, types = parsed[i]
        one, two = (dst, src) if back else (src, dst)
        return edges.where(F.col(kind).isin(types)).select(F.col(one).alias(f"n{i}"), F.col(two).alias(f"n{i + 1}"), F.col(kind).alias(f"__k{i}"))

    size = [sum(counts.get(t, 0) for t in types) for _, types in parsed]
    low = high = size.index(min(size))
    found = fitting(low)
    while high - low + 1 < len(parsed):
        left = low > 0 and (high == len(parsed) - 1 or size[low - 1] <= size[high + 1])
        low, high = (low - 1, high) if left else (low, high + 1)
        at = low if left else high
        found = found.join(fitting(at), f"n{low + 1}" if left else f"n{high}")
        for other in range(low, high + 1):
            if other != at and set(parsed[other][1]) & set(parsed[at][1]):
                found = found.where(~_same_edge(parsed, at, other))
    return found.select(*[f"n{i}" for i in range(len(parsed) + 1)])


def _same_edge(steps: list, i: int, j: int) -> Column:
    """Whether two steps of a chain are one edge."""
    ends = [(f"n{k + 1}", f"n{k}") if steps[k][0] else (f"n{k}", f"n{k + 1}") for k in (i, j)]
    (a, b), (c, d) = ends
    return (F.col(a) == F.col(c)) & (F.col(b) == F.col(d)) & (F.col(f"__k{i}") == F.col(f"__k{j}"))


def graph_elements(records: DataFrame, company: str = "company", item: str = "item_name", year: str = "year", period: str = "period", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Records as a drawing: distinct nodes ``(id, label)`` and labelled edges ``(source, target, label)``.

    A record names what it has of a company, an item, a year, a period and a value; columns that are not there are none. A value is a node
    of its company, item and year, and of several the smallest label stands. Blank names are none.
    """

    def text(c: str) -> Column:
        if c not in records.columns:
            return F.lit(None).cast("string")
        t = F.col(c).cast("string")
        return F.when(t != "", t)

    parts = {"company": text(company), "item": text(item), "year": text(year), "period": text(period)}
    ids = {k: F.concat(F.lit(f"{k}:"), v) for k, v in parts.items()}
    held = F.concat(F.lit("value:"), *[x for k in ("company", "item", "year") for x in (F.coalesce(parts[k], F.lit("None")), F.lit(":"))][:-1])
    ids["value"] = F.when(text(value).isNotNull(), held)
    labels = parts | {"year": F.concat(F.lit("Y:"), parts["year"]), "period": F.concat(F.lit("P:"), parts["period"]), "value": F.concat(F.lit("V:"), text(value))}
    made = F.array(*[F.struct(ids[k].alias("id"), labels[k].alias("label")) for k in ids])
    nodes = records.select(F.explode(made).alias("n")).where("n.id is not null").groupBy("n.id").agg(F.min("n.label").alias("label"))
    links = (("company", "item", "has_data"), ("item", "year", "in_year"), ("year", "period", "period"), ("item", "value", "value"))
    drawn = F.array(*[F.struct(ids[a].alias("source"), ids[b].alias("target"), F.lit(name).alias("label")) for a, b, name in links])
    edges = records.select(F.explode(drawn).alias("e")).select("e.*").where("source is not null and target is not null").distinct()
    return nodes, edges


def limited(df: DataFrame, group: str, order: Sequence[str], most: dict[str, int], default: int = 50) -> DataFrame:
    """The first rows of each group in an order, as many as its name allows.

    Rows beyond the largest limit are dropped before the groups are dealt out, so a large group costs no more than others.
    """
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    allowed = F.when(F.lit(False), 0)
    for name, n in most.items():
        allowed = allowed.when(F.col(group) == name, n)
    return ranked.where(F.col("__rank") <= max([default, *most.values()])).where(F.col("__rank") <= allowed.otherwise(default)).drop("__rank")


def sampled_properties(tables: dict[str, DataFrame]) -> DataFrame:
    """What tables of nodes are made of: ``label, property, type, filled, smallest, largest``, a row for each column; one pass for each table."""
    frames = []
    for label, df in tables.items():
        columns = df.columns
        facts = [
            F.struct(
                F.lit(c).alias("property"), F.lit(df.schema[c].dataType.simpleString()).alias("type"), F.count(F.col(c)).alias("filled"),
                F.min(F.col(c).cast("string")).alias("smallest"), F.max(F.col(c).cast("string")).alias("largest"),
            )
            for c in columns
        ]
        frames.append(df.agg(F.array(*facts).alias("f")).select(F.lit(label).alias("label"), F.explode("f").alias("f")).select("label", "f.*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
