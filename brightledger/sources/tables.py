"""Tables read from a folder of Parquet, and the logical tables of statement analytics derived from them.

Every function takes ``(spark, folder)``. Filters and column choices reach the Parquet scans, since nothing
here is cached or collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to all parts by their keys, however small the file: for tables whose rows make much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def in_years(date: str, years: Sequence[int]) -> Column:
    """Whether a time falls into one of some years, as ranges, which a scan can skip row groups by."""

    def begins(year: int) -> Column:
        return F.lit(f"{year:04d}-01-01").cast("timestamp")

    ranges = ((F.col(date) >= begins(y)) & (F.col(date) < begins(y + 1)) for y in sorted(set(years)))
    return reduce(Column.__or__, ranges, F.lit(False))


def statement_rows(spark: SparkSession, folder: str, years: Sequence[int] | None = None) -> DataFrame:
    """One row per posting: ``company, item_name, section_code, year, amount`` and the order's keys; of some years, or all."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    if years is not None:
        orders = orders.where(in_years("o_orderdate", years))
    parts = table(spark, folder, "part")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)
    return joined.select(
        F.col("l_suppkey").alias("company"),
        F.col("o_custkey").alias("partner"),
        F.col("p_type").alias("item_name"),
        F.col("p_brand").alias("brand"),
        F.col("l_returnflag").alias("section_code"),
        F.year("o_orderdate").alias("year"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_orderpriority").alias("priority"),
    )


def statements(spark: SparkSession, folder: str, years: Sequence[int] | None = None) -> DataFrame:
    """Statement data: one value per item, section and year."""
    rows = statement_rows(spark, folder, years)
    return rows.groupBy("item_name", "section_code", "year").agg(F.sum("amount").cast(MONEY).alias("value"))


def company_edges(spark: SparkSession, folder: str, years: Sequence[int] | None = None) -> DataFrame:
    """Postings between a company and a partner, typed by their flag: trades, owes or invests."""
    rows = statement_rows(spark, folder, years)
    kind = F.when(F.col("section_code") == "R", "trades").when(F.col("section_code") == "A", "owes").otherwise("invests")
    return rows.select(
        F.col("company").alias("src_id"), F.col("partner").alias("dst_id"), kind.alias("rel_type"), "priority", "year", "amount",
        "order_key", "line_number",
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """A hierarchy of three levels (region, nation, customer) with its paths."""
    region, nation, customer = (table(spark, folder, t) for t in ("region", "nation", "customer"))
    one = region.select(F.col("r_name").alias("name"), F.lit(1).alias("level"), F.col("r_name").alias("category_path"), F.lit(None).cast("string").alias("parent_path"))
    both = nation.join(region, nation.n_regionkey == region.r_regionkey)
    path = F.concat_ws(">", "r_name", "n_name")
    two = both.select(F.col("n_name").alias("name"), F.lit(2).alias("level"), path.alias("category_path"), F.col("r_name").alias("parent_path"))
    leaf = customer.join(both, customer.c_nationkey == both.n_nationkey)
    three = leaf.select(
        F.col("c_name").alias("name"), F.lit(3).alias("level"), F.concat_ws(">", "r_name", "n_name", "c_name").alias("category_path"), path.alias("parent_path")
    )
    return one.unionByName(two).unionByName(three)


def labelled_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered labels with levels 1 to 5, a table for each user of the events."""
    levels = {"signup": 1, "view": 2, "click": 3, "purchase": 4, "error": 5}
    level = F.create_map(*[F.lit(x) for pair in levels.items() for x in pair])[F.col("event_type")]
    e = table(spark, folder, "events")
    return e.select(
        F.col("user_id").alias("table_id"), "ts", F.col("event_id").alias("pos"), level.alias("level"),
        F.concat("event_type", F.lit("-"), F.col("event_id").cast("string")).alias("name"),
    )


def notes(spark: SparkSession, folder: str) -> DataFrame:
    """Notes of yearly reports: documents dealt to years and note numbers, in order of ``seq``."""
    d = table(spark, folder, "documents")
    return d.select(
        F.col("source").alias("company"),
        (F.lit(2014) + F.col("doc_id") % 11).cast("int").alias("year"),
        (F.col("doc_id") % 7).cast("int").alias("note_number"),
        F.col("doc_id").alias("seq"),
        F.substring("text", 1, 40).alias("title"),
        F.col("text").alias("content"),
    )


def cell_columns() -> tuple[tuple[str, Column], ...]:
    """The columns of statement tables, of postings: names and printed texts."""
    whole = F.floor("l_extendedprice").cast("long").cast("string")
    printed = (
        F.when(F.col("l_linenumber") % 5 == 0, F.lit("-"))
        .when(F.col("l_linenumber") % 5 == 1, F.concat(F.lit("("), whole, F.lit(")")))
        .when(F.col("l_linenumber") % 5 == 2, F.concat(F.substring(whole, 1, 2), F.lit(","), F.substring(whole, 3, 20)))
        .when(F.col("l_linenumber") % 5 == 3, F.concat(F.lit("- "), whole))
        .otherwise(whole)
    )
    label = F.concat(F.col("l_linenumber").cast("string"), F.lit(". "), F.col("l_returnflag"), F.lit("항목"))
    notes_ = F.concat((F.col("l_partkey") % 30).cast("string"), F.lit(", "), (F.col("l_suppkey") % 30).cast("string"))
    before = F.floor("l_quantity").cast("long").cast("string")
    return (("과 목", label), ("주석", notes_), ("제 56 (당) 기", printed), ("제 55 (전) 기.1", before))


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Statement tables in long form: a table per order, a row per line, a cell per column, as printed text."""
    l = table(spark, folder, "lineitem")
    made = [F.struct(F.lit(i).alias("col_index"), F.lit(name).alias("column_name"), text.alias("text")) for i, (name, text) in enumerate(cell_columns())]
    row = l.select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("row_index"), F.explode(F.array(*made)).alias("c"))
    return row.select("table_id", "row_index", "c.col_index", "c.column_name", "c.text")


# --- the same logical tables for the SQL that queries are held against

STATEMENT_ROWS_SQL = """statement_rows AS (
  SELECT l_suppkey AS company, o_custkey AS partner, p_type AS item_name, p_brand AS brand, l_returnflag AS section_code,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         l_orderkey AS order_key, l_linenumber AS line_number, o_orderpriority AS priority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""
STATEMENTS_SQL = (
    STATEMENT_ROWS_SQL
    + """, statements AS (
  SELECT item_name, section_code, year, CAST(sum(amount) AS DECIMAL(18,2)) AS value FROM statement_rows GROUP BY item_name, section_code, year
)"""
)
EDGES_SQL = (
    STATEMENT_ROWS_SQL
    + """, edges AS (
  SELECT company AS src_id, partner AS dst_id,
         CASE section_code WHEN 'R' THEN 'trades' WHEN 'A' THEN 'owes' ELSE 'invests' END AS rel_type,
         priority, year, amount, order_key, line_number
  FROM statement_rows
)"""
)
CATEGORIES_SQL = """categories AS (
  SELECT r_name AS name, 1 AS level, r_name AS category_path, CAST(NULL AS VARCHAR) AS parent_path FROM region
  UNION ALL SELECT n_name, 2, r_name || '>' || n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT c_name, 3, r_name || '>' || n_name || '>' || c_name, r_name || '>' || n_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
LABELLED_SQL = """labelled AS (
  SELECT user_id AS table_id, ts, event_id AS pos,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS level,
         event_type || '-' || CAST(event_id AS VARCHAR) AS name
  FROM events
)"""
NOTES_SQL = """notes AS (
  SELECT source AS company, CAST(2014 + doc_id % 11 AS INTEGER) AS year, CAST(doc_id % 7 AS INTEGER) AS note_number, doc_id AS seq,
         substring(text, 1, 40) AS title, text AS content
  FROM documents
)"""
CELLS_SQL = """printed AS (
  SELECT l_orderkey AS table_id, l_linenumber AS row_index, l_returnflag AS flag, l_partkey, l_suppkey, l_quantity,
         CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS whole
  FROM lineitem
), cells AS (
  SELECT table_id, row_index, 0 AS col_index, '과 목' AS column_name, CAST(row_index AS VARCHAR) || '. ' || flag || '항목' AS text FROM printed
  UNION ALL SELECT table_id, row_index, 1, '주석', CAST(l_partkey % 30 AS VARCHAR) || ', ' || CAST(l_suppkey % 30 AS VARCHAR) FROM printed
  UNION ALL SELECT table_id, row_index, 2, '제 56 (당) 기',
    CASE row_index % 5 WHEN 0 THEN '-' WHEN 1 THEN '(' || whole || ')' WHEN 2 THEN substring(whole, 1, 2) || ',' || substring(whole, 3, 20)
         WHEN 3 THEN '- ' || whole ELSE whole END FROM printed
  UNION ALL SELECT table_id, row_index, 3, '제 55 (전) 기.1', CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) FROM printed
)"""
