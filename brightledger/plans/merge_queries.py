"""Upserts batch by batch into merge-on-read tables, against one pass over everything."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.plans.registry import query
from brightledger.sources.merge_table import MergeTable
from brightledger.sources.scratch import fresh_path, written
from brightledger.sources.tables import EDGES_SQL, company_edges, table

#: Batches that the rows arrive in, and that after which the table is compacted.
BATCHES, COMPACTED = 4, 1


def _arrived(spark, rows, number, keys, rule):
    """A table that has taken all rows in batches of their numbers."""
    made = MergeTable(spark, fresh_path(spark), keys=keys, rule=rule, buckets=8, fanout=2)
    # Rows that come of joins are made once for all batches.
    rows = written(rows.withColumn("batch", number))
    number = F.col("batch")
    for i in range(BATCHES):
        made.upsert(rows.where(number == i).drop("batch"))
        if i == COMPACTED:
            made.compact()
    return made.read()


@query(
    "s9_merge_on_read",
    "SELECT l_partkey AS id, (max(struct_pack(a := l_orderkey * 10 + l_linenumber, b := l_suppkey % 4, c := l_quantity))).a AS seq, (max(struct_pack(a := l_orderkey * 10 + l_linenumber, b := l_suppkey % 4, c := l_quantity))).c AS quantity FROM lineitem GROUP BY 1",
)
def merge_on_read(spark, d):
    """Parts' last lines, upserted in batches that arrive out of order, with a compaction between."""
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_quantity").alias("quantity"), (F.col("l_suppkey") % BATCHES).alias("batch"))
    return _arrived(spark, rows, F.col("batch"), ["id"], "last")


@query(
    "s12_merged_edges",
    f"""WITH {EDGES_SQL}, f AS (SELECT src_id, dst_id, rel_type, struct_pack(b := year % 4, s := order_key * 10 + line_number) AS turn, CASE WHEN line_number % 3 > 0 THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN line_number % 2 = 0 THEN priority END AS priority FROM edges)
SELECT src_id, dst_id, rel_type, (min({{'s': turn, 'v': amount}}) FILTER (WHERE amount IS NOT NULL)).v AS amount, (min({{'s': turn, 'v': priority}}) FILTER (WHERE priority IS NOT NULL)).v AS priority FROM f GROUP BY 1, 2, 3""",
)
def merged_edges(spark, d):
    """Edges whose properties keep their first values and fill where those are null, batch by batch."""
    line = F.col("line_number")
    rows = company_edges(spark, d).select(
        "src_id", "dst_id", "rel_type", (F.col("order_key") * 10 + line).alias("seq"), F.when(line % 3 > 0, F.col("amount").cast("double")).alias("amount"), F.when(line % 2 == 0, F.col("priority")).alias("priority"),
        (F.col("year") % BATCHES).alias("batch"),
    )
    return _arrived(spark, rows, F.col("batch"), ["src_id", "dst_id", "rel_type"], "first").drop("seq")
