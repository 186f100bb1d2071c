"""Hierarchies: paths of ordered labels, rollups, levels, reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.sources.scratch import written


def label_paths(
    df: DataFrame, table: str = "table_id", pos: str = "pos", level: str = "level", name: str = "name", root: str = "root", levels: int = 5
) -> DataFrame:
    """The path of each label: the last label of each smaller level that no shallower one has replaced.

    One window per table. For each level the last label before the row is carried along; it counts if it
    came after the last label of every smaller level. A missing level makes the row a child of what is there.
    """
    before = W.partitionBy(table).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    at = {k: F.last(F.when(F.col(level) == k, F.struct(pos, name)), ignorenulls=True).over(before) for k in range(1, levels)}
    out = df.withColumns({f"__l{k}": c for k, c in at.items()})
    # The parent is the label one level up, if nothing shallower came since; else the row hangs from the root.
    parents = []
    for k in range(1, levels):
        here = F.col(f"__l{k}")
        shallower = [F.coalesce(F.col(f"__l{j}.{pos}") > here[pos], F.lit(False)) for j in range(1, k)]
        gone = F.lit(False)
        for s in shallower:
            gone = gone | s
        parents.append((k, here.isNotNull() & ~gone))
    path = F.array(F.lit(root), F.col(name))
    for depth in range(2, levels + 1):
        # Ancestors at depth-1, depth-2, ..., as long as each has its own parent.
        chain = F.array().cast("array<string>")
        alive = F.lit(True)
        for k in range(depth - 1, 0, -1):
            alive = alive & dict(parents)[k]
            if k < depth - 1:
                # The ancestor itself must hang from this one: it came later.
                alive = alive & F.coalesce(F.col(f"__l{k + 1}.{pos}") > F.col(f"__l{k}.{pos}"), F.lit(False))
            chain = F.concat(F.when(alive, F.array(F.col(f"__l{k}.{name}"))).otherwise(F.array().cast("array<string>")), chain)
        path = F.when(F.col(level) == depth, F.concat(F.array(F.lit(root)), chain, F.array(F.col(name)))).otherwise(path)
    return out.withColumn("category_path", F.array_join(path, ">")).drop(*[f"__l{k}" for k in at])


def fill_labels(df: DataFrame, table: str, pos: str, name: str) -> DataFrame:
    """A blank label takes the last one above it in its table; blanks at the top stay null."""
    filled = F.when(F.trim(F.col(name)) != "", F.col(name))
    w = W.partitionBy(table).orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.last(filled, ignorenulls=True).over(w))


def path_rollup(df: DataFrame, path: str = "category_path", value: str = "value") -> DataFrame:
    """Sum and count of every path prefix, with its parent: each row counts for all its ancestors."""
    rows = df.select(value, F.split(path, ">").alias("__parts")).select(value, "__parts", F.explode(F.sequence(F.lit(1), F.size("__parts"))).alias("depth"))
    prefix = F.array_join(F.slice("__parts", F.lit(1), F.col("depth")), ">")
    rows = rows.select(value, "depth", prefix.alias("prefix"), F.element_at("__parts", F.col("depth")).alias("label"))
    parent = F.regexp_replace("prefix", ">[^>]*$", "")
    return (
        rows.groupBy("prefix", "label", "depth")
        .agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("n"))
        .withColumn("parent", F.when(F.col("depth") > 1, parent))
    )


def sharpened(df: DataFrame, keys: list[str], seq: str, level: str, has_notes: str, keep: list[str]) -> DataFrame:
    """One row per key by an ordered fold: a row replaces what is held if it has notes and that has not, or is of a lower level."""
    row = F.struct(F.col(seq).alias("seq"), F.col(level).alias("level"), F.col(has_notes).alias("notes"), *keep)
    rows = F.array_sort(F.collect_list(row))

    def better(held, new):
        return F.when((new["notes"] & ~held["notes"]) | (new["level"] < held["level"]), new).otherwise(held)

    folded = df.groupBy(*keys).agg(rows.alias("__rows"))
    held = F.aggregate(F.slice("__rows", F.lit(2), F.size("__rows")), F.col("__rows")[0], better)
    return folded.select(*keys, held.alias("h")).select(*keys, "h.seq", "h.level", "h.notes", *[f"h.{k}" for k in keep])


def descendants(edges: DataFrame, roots: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(root, node, depth)``: everything that a path of edges leads to, and the length of the shortest one.

    A round for each depth: what the last round found goes one edge on, and what is known already is left out, so cycles
    end and several ways to a node count once.
    """
    column = roots.columns[0]
    edges = written(edges.select(F.col(src).alias("__src"), F.col(dst).alias("__dst")).distinct())
    last = roots.select(F.col(column).alias("root"), F.col(column).alias("node")).distinct()
    known, depth = None, 1
    while True:
        onward = last.join(edges, F.col("node") == F.col("__src")).select("root", F.col("__dst").alias("node")).distinct()
        fresh = onward if known is None else onward.join(known, ["root", "node"], "left_anti")
        fresh = written(fresh.withColumn("depth", F.lit(depth)))
        if known is not None and fresh.isEmpty():
            return known
        known = fresh if known is None else known.unionByName(fresh)
        last, depth = fresh.select("root", "node"), depth + 1
