"""Loads as they run: measured writes, tables kept by year, reports as files."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.operators import upsert
from brightledger.operators.metrics import RunMetrics
from brightledger.plans.registry import query
from brightledger.plans.statement_pipeline import build
from brightledger.sources import store as S
from brightledger.sources import yearly
from brightledger.sources.scratch import fresh_path, written
from brightledger.sources.tables import EDGES_SQL, STATEMENT_ROWS_SQL, STATEMENTS_SQL, company_edges, statement_rows, statements, table

KINDS = ("trades", "owes", "invests")
FIGURES = "total_items", "processed_items", "failed_items", "success_rate", "measured"


def _figures(metrics: RunMetrics):
    """A run's figures, with whether its time was taken in place of the time itself."""
    timed = (F.col("duration_seconds") > 0) & ((F.col("throughput_per_second") > 0) | (F.col("processed_items") == 0))
    return metrics.frame().withColumns({"success_rate": F.round("success_rate", 6), "measured": timed})


@query(
    "s17_measured_edges",
    f"""WITH {EDGES_SQL}, tried AS (SELECT DISTINCT src_id, dst_id, rel_type FROM edges), made AS (
  SELECT * FROM tried WHERE src_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND dst_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
SELECT t.rel_type AS kind, total_items, coalesce(processed_items, 0) AS processed_items, total_items - coalesce(processed_items, 0) AS failed_items, round(coalesce(processed_items, 0) * 100.0 / total_items, 6) AS success_rate, true AS measured
FROM (SELECT rel_type, count(*) AS total_items FROM tried GROUP BY 1) t LEFT JOIN (SELECT rel_type, count(*) AS processed_items FROM made GROUP BY 1) m USING (rel_type)""",
)
def measured_edges(spark, d):
    """Edges tried and written, by type, as counted while they were written."""
    metrics = RunMetrics(spark)
    s = table(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey")
    c = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey")
    made = upsert.existing_edges(company_edges(spark, d), s, c, attempted=lambda df: metrics.attempted("edges", df, "rel_type", KINDS))
    metrics.measured("edges", made.select("src_id", "dst_id", "rel_type"), lambda df: df.write.parquet(fresh_path(spark)))
    return _figures(metrics).select("kind", *FIGURES)


LOAD_SQL = f"""{STATEMENTS_SQL}, y AS (SELECT DISTINCT section_code, year FROM statements), counted AS (
  SELECT 'companies' AS operation, NULL AS kind, 1 AS n UNION ALL SELECT 'sections', NULL, count(DISTINCT section_code) FROM y UNION ALL SELECT 'years', NULL, count(*) FROM y UNION ALL SELECT 'data', NULL, count(*) FROM statements
  UNION ALL SELECT 'edges', 'contains_data', count(*) FROM statements UNION ALL SELECT 'edges', 'has_year_data', count(*) FROM y UNION ALL SELECT 'edges', 'has_financial_statement', count(DISTINCT section_code) FROM y
  UNION ALL SELECT 'edges', 'precedes', sum(n - 1) FROM (SELECT section_code, count(*) AS n FROM y GROUP BY 1))"""


def _loaded(spark, d) -> RunMetrics:
    """What a load of statements into a store did; the values, which most tables come of, are made once."""
    metrics = RunMetrics(spark)
    made = build(written(statements(spark, d)), metrics=metrics)
    del made["trends"]
    S.Store(spark, fresh_path(spark)).write(made, metrics=metrics)
    return metrics


@query("s17_measured_load", f"WITH {LOAD_SQL} SELECT operation, kind, CAST(n AS BIGINT) AS total_items, CAST(n AS BIGINT) AS processed_items, CAST(0 AS BIGINT) AS failed_items, 100.0::DOUBLE AS success_rate, true AS measured FROM counted")
def measured_load(spark, d):
    """A load of statements into a store, step by step, edges by type."""
    return _figures(_loaded(spark, d)).select("operation", "kind", *FIGURES)


@query("s17_run_summary", f"WITH {LOAD_SQL} SELECT CAST(5 AS BIGINT) AS operations_count, CAST(sum(n) AS BIGINT) AS total_items, CAST(sum(n) AS BIGINT) AS total_processed, 100.0::DOUBLE AS overall_success_rate, true AS measured FROM counted")
def run_summary(spark, d):
    """The same load in one row."""
    timed = (F.col("total_duration_seconds") > 0) & (F.col("average_throughput") > 0)
    return _loaded(spark, d).summary().select("operations_count", "total_items", "total_processed", "overall_success_rate", timed.alias("measured"))


def _yearly_path(spark, d):
    path = fresh_path(spark)
    yearly.write_yearly(statement_rows(spark, d).select("company", "section_code", "amount", "year"), path)
    return path


@query(
    "s1_years_of_a_store",
    f"WITH {STATEMENT_ROWS_SQL} SELECT year, section_code, count(*) AS n, sum(amount) AS amount FROM statement_rows WHERE year IN (1995, 1997, 2000, 1800, 2021) GROUP BY 1, 2",
)
def years_of_a_store(spark, d):
    """Rows of some named years of a table that is kept by year; years that are not there are absent."""
    rows = yearly.read_yearly(spark, _yearly_path(spark, d), [1995, 1997, 2000, 1800, 2021])
    return rows.groupBy("year", "section_code").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(38,2)").alias("amount"))


@query(
    "p1_years_of_another_table",
    f"WITH {STATEMENT_ROWS_SQL}, y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderkey % 4000 = 7) SELECT company, count(*) AS n FROM statement_rows WHERE year IN (SELECT year FROM y) GROUP BY 1",
)
def years_of_another_table(spark, d):
    """Rows of the years that another table speaks of: the scan is pruned while the query runs."""
    o = table(spark, d, "orders").where("o_orderkey % 4000 = 7").select(F.year("o_orderdate").alias("year"))
    return yearly.read_yearly(spark, _yearly_path(spark, d), o).groupBy("company").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s1_parsed_reports",
    """WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, o_orderstatus FROM orders), y AS (SELECT list(DISTINCT year ORDER BY year)[1:2] AS first_years FROM o)
SELECT year, 'report ' || o_orderkey AS name, unnest([o_orderpriority, 'notes of ' || o_orderstatus]) AS title, unnest([0, 1]) AS seq, unnest([1, 2]) AS level FROM o, y WHERE list_contains(first_years, year)""",
)
def parsed_reports(spark, d):
    """Reports written as JSON by year and read back for the first two years, their sections as rows."""
    year = F.year("o_orderdate")
    child = F.array(F.struct(F.concat(F.lit("notes of "), F.col("o_orderstatus")).alias("title"), F.lit("c").alias("content")))
    section = F.struct(F.col("o_orderpriority").alias("title"), F.lit("c").alias("content"), child.alias("subsections"))
    reports = table(spark, d, "orders").select(F.concat(F.lit("report "), F.col("o_orderkey").cast("string")).alias("name"), F.array(section).alias("sections"), year.alias("year"))
    path = fresh_path(spark)
    S.write_reports(reports, path)
    first = [r.year for r in reports.select("year").distinct().orderBy("year").limit(2).collect()]
    read = S.parsed_reports(spark, path, reports.schema, first)
    flat = S.flattened_sections(read.withColumn("key", F.struct("year", "name")), "key")
    return flat.select("key.year", "key.name", "title", F.col("seq").cast("int").alias("seq"), "level")
