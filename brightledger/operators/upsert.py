"""Idempotent upserts of node and edge tables.

A table cannot be overwritten while it is read, so callers write the result to a new place and switch to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(target: DataFrame, batch: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """Rows of both: the batch's before the target's, then the one with the largest ``seq``, then the largest row.

    An aggregation, not a window: copies are combined before the shuffle, so a hot key costs nothing.
    """
    both = target.withColumn("__new", F.lit(0)).unionByName(batch.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (key, "__new")]
    newest = both.groupBy(key).agg(F.max(F.struct("__new", F.col(seq).alias("__seq"), *rest)).alias("__row"))
    return newest.select(key, *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def first_filled(df: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: str = "seq") -> DataFrame:
    """For each key, each column's first value in order of ``seq`` (then the smallest) that is not null."""
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("s"), F.col(c).alias("v")))).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*first).select(*keys, *[F.col(f"`{c}`.v").alias(c) for c in columns])


def first_wins(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: str = "seq") -> DataFrame:
    """Full outer join on the keys; what the target has stays, the batch fills its nulls."""
    old = target.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in columns])
    new = first_filled(batch, keys, columns, seq)
    joined = old.join(new, list(keys), "full")
    return joined.select(*keys, *[F.coalesce(f"__old_{c}", c).alias(c) for c in columns])


def existing_edges(
    edges: DataFrame, sources: DataFrame, targets: DataFrame, src: str = "src_id", dst: str = "dst_id", kind: str = "rel_type",
    attempted: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One edge for each source, target and type, where both ends exist.

    ``sources`` and ``targets`` have one column each, of distinct ids. ``attempted`` may observe the distinct edges before their ends
    are looked up.
    """
    distinct = attempted(edges.dropDuplicates([src, dst, kind]))
    from_ = sources.select(F.col(sources.columns[0]).alias(src))
    to = targets.select(F.col(targets.columns[0]).alias(dst))
    return distinct.join(from_, src, "left_semi").join(to, dst, "left_semi")


def dangling_edges(edges: DataFrame, nodes: DataFrame, end: str, node_id: str = "id") -> DataFrame:
    """Edges whose ``end`` is no node."""
    return edges.join(nodes.select(F.col(node_id).alias(end)).distinct(), end, "left_anti")


def edge_metrics(attempted: DataFrame, created: DataFrame, kind: str = "rel_type") -> DataFrame:
    """Per edge type: attempted, processed, failed and the success rate in percent."""
    a = attempted.groupBy(kind).agg(F.count(F.lit(1)).alias("total_items"))
    b = created.groupBy(kind).agg(F.count(F.lit(1)).alias("processed_items"))
    both = a.join(b, kind, "left").withColumn("processed_items", F.coalesce("processed_items", F.lit(0)))
    return both.withColumns({
        "failed_items": F.col("total_items") - F.col("processed_items"),
        "success_rate": F.when(F.col("total_items") > 0, F.col("processed_items") / F.col("total_items") * 100).otherwise(0.0),
    })


def merged_edges(edges: DataFrame, keys: Sequence[str], amount: str, others: Sequence[str], seq: str, source: str | None = None) -> DataFrame:
    """Edges merged by key: the largest amount, the first value of each other column that says something.

    Zero and blank say nothing; sources are joined in order, each once.
    """
    def says(c: str):
        # A zero amount and a blank text are as good as missing.
        return F.col(c).isNotNull() & ~F.trim(F.col(c).cast("string")).isin("", "0", "0.0", "0.00")

    aggregates = [F.max(amount).alias(amount)]
    aggregates += [F.min(F.when(says(c), F.struct(F.col(seq).alias("s"), F.col(c).alias("v")))).alias(c) for c in others]
    if source:
        aggregates.append(F.array_join(F.array_sort(F.collect_set(source)), ";").alias(source))
    merged = edges.groupBy(*keys).agg(*aggregates)
    return merged.withColumns({c: F.col(f"`{c}`.v") for c in others})


def clear(path_is_ours: bool, confirm: bool) -> str:
    """The write mode of a load that starts over; refuses without a confirmation."""
    if not confirm:
        raise ValueError("clearing a store needs confirm=True")
    return "overwrite"
