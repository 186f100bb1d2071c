"""The graph store: upserts, edges, ids, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.functions.ids import node_id, sha1_id
from brightledger.operators import graph, upsert
from brightledger.plans.registry import query
from brightledger.sources.tables import EDGES_SQL, company_edges, table

NODES_SQL = """nodes AS (
  SELECT 'nation' AS label, CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
  UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
)"""


def nodes(spark, d):
    """Node tables of three labels; their keys overlap, as ids of careless loads do."""
    parts = [("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name")]
    frames = [table(spark, d, t).select(F.lit(t).alias("label"), F.col(k).cast("long").alias("id"), F.col(n).alias("name")) for t, k, n in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "f1_node_ids",
    """SELECT c_custkey, sha1(lower(trim(c_name)) || '|' || lower(trim(n_name))) AS id, sha1(lower(trim(c_name)) || '|affiliate|' || lower(trim(n_name))) AS affiliate_id
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def node_ids(spark, d):
    """Deterministic ids of customers by name and nation."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select("c_custkey", sha1_id("c_name", "n_name").alias("id"), node_id("affiliate", company="c_name", affiliate="n_name").alias("affiliate_id"))


@query(
    "f2_year_node_ids",
    f"""WITH {EDGES_SQL} SELECT DISTINCT sha1(CAST(src_id AS VARCHAR) || '|' || rel_type || '|' || CAST(year AS VARCHAR)) AS id, src_id, rel_type, year FROM edges""",
)
def year_node_ids(spark, d):
    """Ids of year nodes: company, section and year."""
    e = company_edges(spark, d).select("src_id", "rel_type", "year").distinct()
    return e.select(node_id("year_node", company="src_id", section_code="rel_type").alias("id"), "src_id", "rel_type", "year")


@query(
    "s9_upsert_last_wins",
    """WITH t AS (SELECT l_partkey AS id, max(struct_pack(a := 0, b := l_orderkey * 10 + l_linenumber, c := l_quantity)) AS r FROM lineitem WHERE l_linenumber < 4 GROUP BY 1),
b AS (SELECT l_partkey AS id, max(struct_pack(a := 1, b := l_orderkey * 10 + l_linenumber, c := l_quantity)) AS r FROM lineitem WHERE l_linenumber >= 4 GROUP BY 1)
SELECT coalesce(b.id, t.id) AS id, coalesce(b.r, t.r).b AS seq, coalesce(b.r, t.r).c AS quantity FROM t FULL JOIN b ON t.id = b.id""",
)
def upsert_last_wins(spark, d):
    """A batch of later lines upserted over earlier ones: the last row of each key stays."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_quantity").alias("quantity"), "l_linenumber"
    )
    target, batch = rows.where("l_linenumber < 4").drop("l_linenumber"), rows.where("l_linenumber >= 4").drop("l_linenumber")
    return upsert.last_wins(target, batch)


@query(
    "s10_upsert_first_wins",
    """WITH r AS (SELECT l_suppkey AS id, l_orderkey * 10 + l_linenumber AS seq, CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS quantity,
  CASE WHEN l_partkey % 5 <> 0 THEN l_shipdate END AS shipped, l_linenumber FROM lineitem),
t AS (SELECT id, (min({'s': seq, 'v': quantity}) FILTER (WHERE quantity IS NOT NULL)).v AS quantity, (min({'s': seq, 'v': shipped}) FILTER (WHERE shipped IS NOT NULL)).v AS shipped FROM r WHERE l_linenumber = 1 AND id % 2 = 0 GROUP BY id),
b AS (SELECT id, (min({'s': seq, 'v': quantity}) FILTER (WHERE quantity IS NOT NULL)).v AS quantity, (min({'s': seq, 'v': shipped}) FILTER (WHERE shipped IS NOT NULL)).v AS shipped FROM r WHERE l_linenumber > 1 GROUP BY id)
SELECT coalesce(t.id, b.id) AS id, coalesce(t.quantity, b.quantity) AS quantity, CAST(CAST(coalesce(t.shipped, b.shipped) AS DATE) AS VARCHAR) AS shipped FROM t FULL JOIN b ON t.id = b.id""",
)
def upsert_first_wins(spark, d):
    """A batch that only fills what a target lacks, column by column."""
    p = F.col("l_partkey")
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.when(p % 3 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(p % 5 != 0, F.col("l_shipdate")).alias("shipped"), "l_linenumber",
    )
    columns = ["quantity", "shipped"]
    target = upsert.first_filled(rows.where("l_linenumber = 1 and id % 2 = 0"), ["id"], columns)
    out = upsert.first_wins(target, rows.where("l_linenumber > 1"), ["id"], columns)
    return out.withColumn("shipped", F.col("shipped").cast("date").cast("string"))


EXISTING = f"""WITH {EDGES_SQL}, attempted AS (SELECT DISTINCT src_id, dst_id, rel_type FROM edges),
created AS (SELECT * FROM attempted WHERE src_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND dst_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))"""


def _edges(spark, d):
    e = company_edges(spark, d).select("src_id", "dst_id", "rel_type")
    s = table(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey")
    c = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey")
    return e, upsert.existing_edges(e, s, c)


@query("s11_edge_upsert", EXISTING + " SELECT * FROM created")
def edge_upsert(spark, d):
    """One edge per company, partner and type, where both ends exist."""
    return _edges(spark, d)[1]


@query(
    "s11_edge_metrics",
    EXISTING + """ SELECT rel_type, total_items, coalesce(processed_items, 0) AS processed_items, total_items - coalesce(processed_items, 0) AS failed_items,
  round(coalesce(processed_items, 0) * 100.0 / total_items, 6) AS success_rate
FROM (SELECT rel_type, count(*) AS total_items FROM attempted GROUP BY 1) a LEFT JOIN (SELECT rel_type, count(*) AS processed_items FROM created GROUP BY 1) c USING (rel_type)""",
)
def edge_metrics(spark, d):
    """Attempted and created edges by type."""
    e, created = _edges(spark, d)
    out = upsert.edge_metrics(e.distinct(), created)
    return out.withColumn("success_rate", F.round("success_rate", 6))


@query(
    "s12_edge_properties",
    f"""WITH {EDGES_SQL}, f AS (SELECT src_id, dst_id, rel_type, order_key * 10 + line_number AS seq, CAST(amount AS DOUBLE) AS amount, CASE WHEN line_number % 2 = 0 THEN priority END AS priority FROM edges)
SELECT src_id, dst_id, rel_type, (min({{'s': seq, 'v': amount}})).v AS amount, (min({{'s': seq, 'v': priority}}) FILTER (WHERE priority IS NOT NULL)).v AS priority FROM f GROUP BY 1, 2, 3""",
)
def edge_properties(spark, d):
    """Edges whose properties keep their first value and fill where it is null."""
    e = company_edges(spark, d).withColumns({
        "seq": F.col("order_key") * 10 + F.col("line_number"), "amount": F.col("amount").cast("double"), "priority": F.when(F.col("line_number") % 2 == 0, F.col("priority")),
    })
    return upsert.first_filled(e, ["src_id", "dst_id", "rel_type"], ["amount", "priority"])


@query("s13_edges_by_properties", f"WITH {EDGES_SQL} SELECT DISTINCT src_id, dst_id, rel_type, year, priority FROM edges")
def edges_by_properties(spark, d):
    """Edges that differ in a property are different edges."""
    return company_edges(spark, d).select("src_id", "dst_id", "rel_type", "year", "priority").distinct()


@query("a14_label_counts", f"WITH {NODES_SQL} SELECT coalesce(label, 'TOTAL') AS label, count(*) AS n FROM nodes GROUP BY ROLLUP (label)")
def label_counts(spark, d):
    """Nodes by label, and all."""
    return graph.label_counts(nodes(spark, d))


@query("a14_edge_counts", f"WITH {EDGES_SQL} SELECT coalesce(rel_type, 'TOTAL') AS rel_type, count(*) AS n FROM edges GROUP BY ROLLUP (rel_type)")
def edge_counts(spark, d):
    """Edges by type, and all."""
    return graph.label_counts(company_edges(spark, d), "rel_type")


@query("a15_duplicate_ids", f"WITH {NODES_SQL} SELECT id, count(*) AS n, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM nodes GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark, d):
    """Ids that several nodes share."""
    return graph.duplicate_ids(nodes(spark, d), most=None)


@query("p6_orphans", f"WITH {EDGES_SQL} SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT dst_id FROM edges WHERE rel_type = 'owes') AND c_custkey NOT IN (SELECT src_id FROM edges WHERE rel_type = 'owes')")
def orphans(spark, d):
    """Customers without an edge of debt."""
    n = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return graph.orphans(n, company_edges(spark, d).where("rel_type = 'owes'"))


@query("j20_dangling_edges", f"WITH {EDGES_SQL} SELECT rel_type, count(*) AS n FROM edges WHERE dst_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY rel_type")
def dangling_edges(spark, d):
    """Edges by type whose partner is missing."""
    n = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    return upsert.dangling_edges(company_edges(spark, d), n, "dst_id").groupBy("rel_type").agg(F.count(F.lit(1)).alias("n"))


DIRTY = """dirty AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS priority,
  CASE WHEN o_custkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS printed, CAST(year(o_orderdate) + 5 AS INTEGER) AS year FROM orders)"""


def dirty(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_custkey") % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("printed"), (F.year("o_orderdate") + 5).alias("year"),
    )


@query("v2_required_properties", f"WITH {DIRTY} SELECT 'status' AS property, count(*) FILTER (WHERE status IS NULL) AS n FROM dirty UNION ALL SELECT 'priority', count(*) FILTER (WHERE priority IS NULL) FROM dirty")
def required_properties(spark, d):
    """Missing required properties."""
    return graph.null_counts(dirty(spark, d), ["status", "priority"])


@query(
    "v4_value_quality",
    f"""WITH {DIRTY} SELECT 'bad_value' AS "check", count(*) FILTER (WHERE NOT regexp_full_match(printed, '-?[0-9]+\\.?[0-9]*')) AS n FROM dirty
UNION ALL SELECT 'bad_year', count(*) FILTER (WHERE NOT year BETWEEN 2002 AND 2030) FROM dirty UNION ALL SELECT 'no_name', count(*) FILTER (WHERE priority IS NULL) FROM dirty""",
)
def value_quality(spark, d):
    """Values, years and names that are not what they should be."""
    return graph.value_quality(dirty(spark, d), "printed", "year", "priority", first=2002)


@query(
    "v1_coverage",
    """WITH e AS (SELECT DISTINCT c_custkey AS id FROM customer), f AS (SELECT o_custkey AS id, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT * FROM (SELECT e.id, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) = 0 THEN 'critical' WHEN n < 4 THEN 'warning' END AS severity FROM e LEFT JOIN f ON e.id = f.id) WHERE severity IS NOT NULL""",
)
def coverage(spark, d):
    """Customers with no or few urgent orders, as issues."""
    expected = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    found = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    return graph.coverage(expected, found, "id", 4)


@query(
    "v5_severity_summary",
    """WITH e AS (SELECT DISTINCT c_custkey AS id FROM customer), f AS (SELECT o_custkey AS id, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
i AS (SELECT CASE WHEN coalesce(n, 0) = 0 THEN 'critical' WHEN n < 4 THEN 'warning' END AS severity FROM e LEFT JOIN f ON e.id = f.id)
SELECT severity, count(*) AS n, severity <> 'critical' AS passes FROM i WHERE severity IS NOT NULL GROUP BY severity""",
)
def severity_summary(spark, d):
    """Issues by severity."""
    return graph.severity_summary(coverage(spark, d))


@query(
    "v12_store_health",
    f"""WITH {NODES_SQL}, {EDGES_SQL} SELECT 'nodes' AS "check", count(*) AS n FROM nodes UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'companies_without_partners', count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT src_id FROM edges) UNION ALL SELECT 'duplicate_ids', count(*) FROM (SELECT label, id FROM nodes GROUP BY 1, 2 HAVING count(*) > 1)""",
)
def store_health(spark, d):
    """Whether the store is empty, unlinked or has duplicates."""
    n, e = nodes(spark, d), company_edges(spark, d)

    def one(name, df):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")

    lonely = table(spark, d, "supplier").join(e.select(F.col("src_id").alias("s_suppkey")), "s_suppkey", "left_anti")
    twice = n.groupBy("label", "id").count().where("count > 1")
    return one("nodes", n).unionByName(one("edges", e)).unionByName(one("companies_without_partners", lonely)).unionByName(one("duplicate_ids", twice))


@query("s15_label_samples", f"WITH {NODES_SQL} SELECT label, id, name, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY id) AS INTEGER) AS rank FROM nodes) WHERE rank <= 3")
def label_samples(spark, d):
    """Three nodes of each label."""
    return graph.samples(nodes(spark, d), "label", "id")


@query(
    "s18_dry_run",
    "SELECT source, count(*) AS sections, 40 + count(*) FILTER (WHERE contains(text, 'the')) AS estimated_nodes, 2 * (40 + count(*) FILTER (WHERE contains(text, 'the'))) AS estimated_edges FROM documents GROUP BY source",
)
def dry_run(spark, d):
    """How many nodes and edges a load would make, per file."""
    g = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("sections"), (40 + F.count_if(F.col("text").contains("the"))).alias("estimated_nodes"))
    return g.withColumn("estimated_edges", 2 * F.col("estimated_nodes"))


@query("u1_union_distinct", "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer")
def union_distinct(spark, d):
    """Names of several node tables, each once."""
    a, b, c = table(spark, d, "nation").select(F.col("n_name").alias("name")), table(spark, d, "region").select(F.col("r_name").alias("name")), table(spark, d, "customer").select(F.col("c_mktsegment").alias("name"))
    return a.unionByName(b).unionByName(c).distinct()


@query("o4_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def page(spark, d):
    """The third page of twenty orders by price."""
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(40).limit(20)
