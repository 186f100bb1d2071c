"""Hierarchies: paths of labels, rollups, category listings and sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.functions.text import path_keys
from brightledger.operators import hierarchy
from brightledger.plans.registry import query
from brightledger.sources.tables import CATEGORIES_SQL, LABELLED_SQL, STATEMENT_ROWS_SQL, STATEMENTS_SQL, categories, labelled_rows, statement_rows, statements, table


@query(
    "w4_label_paths",
    f"""WITH RECURSIVE {LABELLED_SQL}, prior AS (
  SELECT a.table_id, a.pos, a.level, a.name, (SELECT max(b.pos) FROM labelled b WHERE b.table_id = a.table_id AND b.pos < a.pos AND b.level < a.level) AS before FROM labelled a
), parent AS (
  SELECT p.table_id, p.pos, p.level, p.name, b.pos AS parent_pos FROM prior p LEFT JOIN labelled b ON b.table_id = p.table_id AND b.pos = p.before AND b.level = p.level - 1
), walk(table_id, pos, category_path, up, depth) AS (
  SELECT table_id, pos, name, parent_pos, 1 FROM parent
  UNION ALL SELECT w.table_id, w.pos, p.name || '>' || w.category_path, p.parent_pos, depth + 1 FROM walk w JOIN parent p ON p.table_id = w.table_id AND p.pos = w.up
)
SELECT table_id, pos, 'root>' || arg_max(category_path, depth) AS category_path FROM walk GROUP BY table_id, pos""",
)
def label_paths(spark, d):
    """Paths of ordered labels: the parent is the last label one level up that nothing shallower replaced."""
    return hierarchy.label_paths(labelled_rows(spark, d)).select("table_id", "pos", "category_path")


@query(
    "w5_fill_labels",
    f"""WITH {LABELLED_SQL} SELECT table_id, pos, last_value(CASE WHEN pos % 3 <> 0 THEN name END IGNORE NULLS) OVER (PARTITION BY table_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS name FROM labelled""",
)
def fill_labels(spark, d):
    """Blank labels take the last one above them."""
    rows = labelled_rows(spark, d).withColumn("name", F.when(F.col("pos") % 3 != 0, F.col("name")).otherwise(" "))
    return hierarchy.fill_labels(rows, "table_id", "pos", "name").select("table_id", "pos", "name")


@query(
    "a10_category_fold",
    f"""WITH RECURSIVE {LABELLED_SQL}, r AS (
  SELECT table_id, CAST(pos % 10 AS INTEGER) AS bucket, pos, level, pos % 4 = 0 AS notes, row_number() OVER (PARTITION BY table_id, pos % 10 ORDER BY pos) AS i FROM labelled
), f(table_id, bucket, i, pos, level, notes) AS (
  SELECT table_id, bucket, i, pos, level, notes FROM r WHERE i = 1
  UNION ALL SELECT r.table_id, r.bucket, r.i, CASE WHEN (r.notes AND NOT f.notes) OR r.level < f.level THEN r.pos ELSE f.pos END,
    CASE WHEN (r.notes AND NOT f.notes) OR r.level < f.level THEN r.level ELSE f.level END, CASE WHEN (r.notes AND NOT f.notes) OR r.level < f.level THEN r.notes ELSE f.notes END
  FROM f JOIN r ON r.table_id = f.table_id AND r.bucket = f.bucket AND r.i = f.i + 1
)
SELECT table_id, bucket, arg_max(pos, i) AS seq, arg_max(level, i) AS level, arg_max(notes, i) AS notes FROM f GROUP BY 1, 2""",
)
def category_fold(spark, d):
    """One row per key by the ordered rule: notes before none, or a lower level."""
    rows = labelled_rows(spark, d).withColumns({"bucket": (F.col("pos") % 10).cast("int"), "notes": F.col("pos") % 4 == 0})
    return hierarchy.sharpened(rows, ["table_id", "bucket"], "pos", "level", "notes", []).select("table_id", "bucket", "seq", "level", "notes")


ROLLUP = f"""WITH leaf AS (SELECT r_name || '>' || n_name || '>' || c_name AS path, CAST(c_acctbal AS DECIMAL(18,2)) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "d17_path_rollup",
    ROLLUP + """, p AS (SELECT value, string_split(path, '>') AS a, unnest(range(1, 4)) AS depth FROM leaf)
SELECT array_to_string(a[1:depth], '>') AS prefix, a[depth] AS label, CAST(depth AS INTEGER) AS depth, CASE WHEN depth > 1 THEN array_to_string(a[1:depth - 1], '>') END AS parent,
  CAST(sum(value) AS DOUBLE) AS value, count(*) AS n FROM p GROUP BY ALL""",
)
def path_rollup(spark, d):
    """Every path prefix with its parent, sum and count: the data of a sunburst."""
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    leaf = j.select(F.concat_ws(">", "r_name", "n_name", "c_name").alias("category_path"), F.col("c_acctbal").cast("decimal(18,2)").alias("value"))
    return hierarchy.path_rollup(leaf).withColumn("value", F.col("value").cast("double"))


@query("j17_descendants", f"WITH {CATEGORIES_SQL} SELECT r_name AS root, category_path AS node, level - 1 AS depth FROM categories JOIN region ON category_path LIKE r_name || '>%'")
def descendants(spark, d):
    """All that a path of any length leads to from each region."""
    c = categories(spark, d)
    roots = c.where("level = 1").select(F.col("category_path").alias("root"))
    edges = c.where("parent_path is not null").select(F.col("parent_path").alias("src"), F.col("category_path").alias("dst"))
    return hierarchy.descendants(edges, roots)


@query(
    "f22_path_keys",
    f"""WITH {CATEGORIES_SQL}, k AS (SELECT category_path, list_transform(string_split(category_path, '>'), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(x)), '\\s+', '_', 'g'), '[^0-9a-z가-힣_]', '', 'g'), '_+', '_', 'g'), '_')) AS s FROM categories)
SELECT category_path, array_to_string(s, '>') AS path_normalized, array_to_string(s, ' ') AS path_tokens, array_to_string(list_transform(s, lambda x: regexp_replace(x, '[^0-9a-z가-힣]', '', 'g')), '>') AS path_key FROM k""",
)
def category_path_keys(spark, d):
    """Search keys of category paths."""
    c = categories(spark, d)
    return c.select("category_path", *[v.alias(k) for k, v in path_keys("category_path").items()])


@query("q13_category_listing", f"WITH {CATEGORIES_SQL} SELECT name, level, category_path FROM categories WHERE level <= 2")
def category_listing(spark, d):
    """Categories of the upper levels in order of level and path."""
    return categories(spark, d).where("level <= 2").select("name", "level", "category_path").orderBy("level", "category_path")


@query("q19_category_counts", f"WITH {CATEGORIES_SQL} SELECT level, split_part(category_path, '>', 1) AS section, count(*) AS n FROM categories GROUP BY 1, 2")
def category_counts(spark, d):
    """Categories by section and level."""
    c = categories(spark, d)
    return c.groupBy("level", F.split_part("category_path", F.lit(">"), F.lit(1)).alias("section")).agg(F.count(F.lit(1)).alias("n"))


SUMS = f"WITH {STATEMENT_ROWS_SQL}"


@query("q1_hierarchical_sums", SUMS + " SELECT item_name, brand, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n FROM statement_rows WHERE year = 1997 GROUP BY 1, 2")
def hierarchical_sums(spark, d):
    """Sums and counts of a year by category and subcategory."""
    g = statement_rows(spark, d).where("year = 1997").groupBy("item_name", "brand")
    return g.agg(F.sum("amount").cast("double").alias("total"), F.count(F.lit(1)).alias("n"))


@query("q2_section_categories", SUMS + " SELECT item_name, year, CAST(sum(amount) AS DOUBLE) AS total FROM statement_rows WHERE section_code = 'R' GROUP BY 1, 2")
def section_categories(spark, d):
    """Sums of one section by category and year."""
    return statement_rows(spark, d).where("section_code = 'R'").groupBy("item_name", "year").agg(F.sum("amount").cast("double").alias("total"))


@query("q3_cash_categories", SUMS + " SELECT brand, CAST(sum(amount) AS DOUBLE) AS total FROM statement_rows WHERE section_code = 'N' AND year = 1998 GROUP BY 1")
def cash_categories(spark, d):
    """Sums of another section for a year."""
    return statement_rows(spark, d).where("section_code = 'N' and year = 1998").groupBy("brand").agg(F.sum("amount").cast("double").alias("total"))


@query(
    "q7_category_ranking",
    SUMS + " SELECT brand, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n, round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS average FROM statement_rows GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def category_ranking(spark, d):
    """The ten largest categories."""
    total = F.sum("amount").cast("double")
    g = statement_rows(spark, d).groupBy("brand").agg(total.alias("total"), F.count(F.lit(1)).alias("n"), F.round(total / F.count(F.lit(1)), 6).alias("average"))
    return g.orderBy(F.desc("total"), "brand").limit(10)


@query("q25_path_search", f"WITH {CATEGORIES_SQL} SELECT split_part(category_path, '>', 2) AS nation, count(*) AS n FROM categories WHERE contains(category_path, 'A') AND level = 3 GROUP BY 1")
def path_search(spark, d):
    """Categories whose path has a word, by their parent."""
    c = categories(spark, d).where(F.col("category_path").contains("A") & (F.col("level") == 3))
    return c.groupBy(F.split_part("category_path", F.lit(">"), F.lit(2)).alias("nation")).agg(F.count(F.lit(1)).alias("n"))


@query("q21_year_top_categories", SUMS + " SELECT brand, CAST(sum(amount) AS DOUBLE) AS total FROM statement_rows WHERE year = 1996 AND section_code = 'A' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def year_top_categories(spark, d):
    """The ten largest categories of a year and section."""
    g = statement_rows(spark, d).where("year = 1996 and section_code = 'A'").groupBy("brand").agg(F.sum("amount").cast("double").alias("total"))
    return g.orderBy(F.desc("total"), "brand").limit(10)


@query("q9_cross_section", f"WITH {STATEMENTS_SQL} SELECT a.item_name, a.year, CAST(a.value AS DOUBLE) AS first_value, CAST(b.value AS DOUBLE) AS second_value FROM statements a JOIN statements b ON a.item_name = b.item_name AND a.year = b.year WHERE a.section_code = 'A' AND b.section_code = 'R'")
def cross_section(spark, d):
    """The same item and year in two sections."""
    s = statements(spark, d)
    a = s.where("section_code = 'A'").select("item_name", "year", F.col("value").cast("double").alias("first_value"))
    b = s.where("section_code = 'R'").select("item_name", "year", F.col("value").cast("double").alias("second_value"))
    return a.join(b, ["item_name", "year"])


@query("w7_rank", SUMS + ", t AS (SELECT section_code, item_name, sum(amount) AS total FROM statement_rows GROUP BY 1, 2) SELECT section_code, item_name, CAST(rank() OVER (PARTITION BY section_code ORDER BY total DESC) AS INTEGER) AS rank FROM t")
def ranked_items(spark, d):
    """Items ranked by sum within their section."""
    from pyspark.sql import Window as W

    g = statement_rows(spark, d).groupBy("section_code", "item_name").agg(F.sum("amount").alias("total"))
    return g.select("section_code", "item_name", F.rank().over(W.partitionBy("section_code").orderBy(F.desc("total"))).alias("rank"))
