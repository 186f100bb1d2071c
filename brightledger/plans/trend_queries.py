"""Trends over years (and what the statement tables say about growth)."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.functions.ids import node_id
from brightledger.operators import trends
from brightledger.plans.registry import query
from brightledger.sources.tables import STATEMENTS_SQL, statement_rows, statements, table

KEYS = ["item_name", "section_code"]


def rounded(df, *columns, digits: int = 6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


LAGGED = f"""WITH {STATEMENTS_SQL}, lagged AS (
  SELECT item_name, section_code, year, CAST(value AS DOUBLE) AS current_value,
         CAST(lag(value) OVER (PARTITION BY item_name, section_code ORDER BY year) AS DOUBLE) AS previous_value,
         lag(year) OVER (PARTITION BY item_name, section_code ORDER BY year) AS previous_year
  FROM statements
), rated AS (
  SELECT *, current_value - previous_value AS change_amount,
         CASE WHEN previous_value = 0 THEN 100.0 * sign(current_value) ELSE (current_value - previous_value) / abs(previous_value) * 100 END AS change_rate
  FROM lagged WHERE previous_value IS NOT NULL
), yoy AS (
  SELECT *, CASE WHEN change_rate > 5 THEN 'increasing' WHEN change_rate < -5 THEN 'decreasing' ELSE 'stable' END AS trend_direction FROM rated
)"""


@query(
    "w1_yoy_trend",
    LAGGED + """ SELECT item_name, section_code, year, previous_year, round(current_value, 2) AS current_value, round(previous_value, 2) AS previous_value,
       round(change_amount, 2) AS change_amount, round(change_rate, 6) AS change_rate, trend_direction FROM yoy""",
)
def yoy_trend(spark, d):
    """Each item's value against its previous observed year."""
    out = trends.year_over_year(statements(spark, d), KEYS).drop("trend_type")
    return rounded(rounded(out, "change_rate"), "current_value", "previous_value", "change_amount", digits=2)


OVERALL = """seen AS (
  SELECT item_name, section_code, year, CAST(value AS DOUBLE) AS value FROM {source}
), folded AS (
  SELECT item_name, section_code, count(*) AS n, min(year) AS previous_year, max(year) AS current_year, arg_min(value, year) AS previous_value,
         arg_max(value, year) AS current_value, coalesce(stddev_samp(value), 0) AS volatility, count(*) FILTER (WHERE value > 0) - 1 AS periods,
         arg_min(value, year) FILTER (WHERE value > 0) AS first_up, arg_max(value, year) FILTER (WHERE value > 0) AS last_up
  FROM seen GROUP BY item_name, section_code HAVING count(*) >= 3
), grown AS (
  SELECT *, CASE WHEN periods >= 1 THEN (pow(last_up / first_up, 1.0 / periods) - 1) * 100 ELSE 0 END AS growth FROM folded
)
SELECT item_name, section_code, n, previous_year, current_year, round(previous_value, 2) AS previous_value, round(current_value, 2) AS current_value,
       round(current_value - previous_value, 2) AS change_amount, round(growth, 6) AS growth_rate, round(volatility, 2) AS volatility,
       CASE WHEN growth > 5 THEN 'increasing' WHEN growth < -5 THEN 'decreasing' ELSE 'stable' END AS trend_direction FROM grown"""


def _tidy(df):
    return rounded(rounded(df.drop("trend_type"), "growth_rate"), "previous_value", "current_value", "change_amount", "volatility", digits=2)


@query("a4_overall_trend", f"WITH {STATEMENTS_SQL}, " + OVERALL.format(source="statements"))
def overall_trend(spark, d):
    """Growth, deviation and direction over all years of an item."""
    return _tidy(trends.overall(statements(spark, d), KEYS))


@query(
    "w2_recent_trend",
    f"""WITH {STATEMENTS_SQL}, newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_name, section_code ORDER BY year DESC) AS r FROM statements) WHERE r <= 3
), """
    + OVERALL.format(source="newest"),
)
def recent_trend(spark, d):
    """The overall trend of each item's last three years."""
    return _tidy(trends.recent(statements(spark, d), KEYS))


@query(
    "a5_trend_statistics",
    LAGGED + """ SELECT 'year_over_year' AS trend_type, count(*) AS n, count(*) FILTER (WHERE trend_direction = 'increasing') AS increasing,
       count(*) FILTER (WHERE trend_direction = 'decreasing') AS decreasing, count(*) FILTER (WHERE trend_direction = 'stable') AS stable FROM yoy""",
)
def trend_statistics(spark, d):
    """Counts of trends by type and direction."""
    return trends.statistics(trends.year_over_year(statements(spark, d), KEYS))


@query(
    "a5_top_movers",
    LAGGED + """ SELECT * FROM (SELECT item_name, section_code, year, round(change_rate, 6) AS change_rate FROM yoy ORDER BY change_rate DESC, item_name, section_code, year LIMIT 5)
  UNION ALL SELECT * FROM (SELECT item_name, section_code, year, round(change_rate, 6) FROM yoy ORDER BY change_rate, item_name, section_code, year LIMIT 5)""",
)
def top_movers(spark, d):
    """The five largest rises and falls."""
    t = trends.year_over_year(statements(spark, d), KEYS).select(*KEYS, "year", F.round("change_rate", 6).alias("change_rate"))
    key = [*KEYS, "year"]
    return t.orderBy(F.desc("change_rate"), *key).limit(5).unionByName(t.orderBy("change_rate", *key).limit(5))


@query(
    "w3_year_edges",
    f"""WITH {STATEMENTS_SQL}, y AS (SELECT DISTINCT section_code, year FROM statements)
SELECT * FROM (SELECT section_code, year, lead(year) OVER (PARTITION BY section_code ORDER BY year) AS next_year FROM y) WHERE next_year IS NOT NULL""",
)
def year_edges(spark, d):
    """Edges between consecutive years of a section."""
    return trends.consecutive_years(statements(spark, d))


@query(
    "a18_trend_edge_statistics",
    f"""WITH {STATEMENTS_SQL}, y AS (SELECT section_code, count(DISTINCT year) AS years FROM statements GROUP BY section_code)
SELECT section_code, years - 1 AS created, years - 1 AS expected FROM y""",
)
def trend_edge_statistics(spark, d):
    """Edges between years by section: created and expected."""
    facts = statements(spark, d)
    made = trends.consecutive_years(facts).groupBy("section_code").agg(F.count(F.lit(1)).alias("created"))
    return facts.groupBy("section_code").agg((F.count_distinct("year") - 1).alias("expected")).join(made, "section_code")


@query(
    "j9_year_grid",
    f"""WITH {STATEMENTS_SQL}, g AS (
  SELECT * FROM (SELECT DISTINCT year(o_orderdate) AS year FROM orders), (SELECT DISTINCT o_orderpriority AS section_code FROM orders)
), p AS (SELECT DISTINCT year(o_orderdate) AS year, o_orderpriority AS section_code FROM orders WHERE o_orderstatus = 'P')
SELECT CAST(g.year AS INTEGER) AS year, g.section_code, p.year IS NOT NULL AS has_data FROM g LEFT JOIN p ON g.year = p.year AND g.section_code = p.section_code""",
)
def year_grid(spark, d):
    """All years by all sections, and which have data. Both sides are distinct values, few by nature."""
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("section_code"), "o_orderstatus")
    grid = o.select("year").distinct().crossJoin(o.select("section_code").distinct())
    has = o.where("o_orderstatus = 'P'").select("year", "section_code").distinct().withColumn("has_data", F.lit(True))
    return grid.join(has, ["year", "section_code"], "left").withColumn("has_data", F.coalesce("has_data", F.lit(False)))


@query(
    "u3_missing_years",
    f"""WITH {STATEMENTS_SQL}, g AS (SELECT DISTINCT s.section_code, y.year FROM statements s, (SELECT DISTINCT year FROM statements) y)
SELECT section_code, year FROM g EXCEPT SELECT section_code, year FROM statements WHERE year % 7 <> ascii(section_code) % 7""",
)
def missing_years(spark, d):
    """Years that a section should have and has not (each section skips some years here)."""
    s = statements(spark, d)
    expected = s.select("section_code").distinct().crossJoin(s.select("year").distinct())
    return expected.join(s.where("year % 7 <> ascii(section_code) % 7").select("section_code", "year").distinct(), ["section_code", "year"], "left_anti")


@query(
    "q4_growth_topk",
    f"""WITH {STATEMENTS_SQL}, g AS (
  SELECT a.item_name, a.section_code, CAST(a.value AS DOUBLE) AS first_value, CAST(b.value AS DOUBLE) AS second_value,
         CASE WHEN a.value > 0 THEN (CAST(b.value AS DOUBLE) - CAST(a.value AS DOUBLE)) / CAST(a.value AS DOUBLE) * 100 ELSE 0 END AS growth_rate
  FROM statements a JOIN statements b ON a.item_name = b.item_name AND a.section_code = b.section_code WHERE a.year = 1996 AND b.year = 1997
) SELECT item_name, section_code, round(first_value, 2) AS first_value, round(second_value, 2) AS second_value, round(growth_rate, 6) AS growth_rate
FROM g WHERE abs(growth_rate) > 0 ORDER BY abs(growth_rate) DESC, item_name, section_code LIMIT 15""",
)
def growth_topk(spark, d):
    """The items that changed most between two years."""
    out = trends.pair_growth(statements(spark, d), KEYS, 1996, 1997, top=15)
    return rounded(rounded(out, "growth_rate"), "first_value", "second_value", digits=2)


@query(
    "q12_adjacent_growth",
    f"""WITH {STATEMENTS_SQL}, g AS (
  SELECT b.item_name, b.section_code, b.year, CAST(b.value AS DOUBLE) AS current_value, CAST(a.value AS DOUBLE) AS previous_value,
         (CAST(b.value AS DOUBLE) - CAST(a.value AS DOUBLE)) / CAST(a.value AS DOUBLE) * 100 AS growth_rate
  FROM statements a JOIN statements b ON a.item_name = b.item_name AND a.section_code = b.section_code AND a.year + 1 = b.year WHERE a.value > 0
) SELECT item_name, section_code, year, round(current_value, 2) AS current_value, round(previous_value, 2) AS previous_value, round(growth_rate, 6) AS growth_rate
FROM g WHERE abs(growth_rate) > 5""",
)
def adjacent_growth(spark, d):
    """Growth of more than five percent against the calendar year before."""
    out = trends.adjacent_growth(statements(spark, d), KEYS)
    return rounded(rounded(out, "growth_rate"), "current_value", "previous_value", digits=2)


@query(
    "q27_growth_by_item",
    f"""WITH {STATEMENTS_SQL}, i AS (SELECT item_name, year, CAST(sum(value) AS DOUBLE) AS value FROM statements GROUP BY item_name, year)
SELECT b.item_name, b.year, round((b.value - a.value) / a.value * 100, 6) AS growth_rate FROM i a JOIN i b ON a.item_name = b.item_name AND a.year + 1 = b.year
WHERE a.value > 0 AND abs((b.value - a.value) / a.value * 100) > 10""",
)
def growth_by_item(spark, d):
    """Adjacent-year growth over ten percent, all sections together."""
    s = statements(spark, d).groupBy("item_name", "year").agg(F.sum("value").alias("value"))
    return rounded(trends.adjacent_growth(s, ["item_name"], least=10.0), "growth_rate").select("item_name", "year", "growth_rate")


@query(
    "q8_trend_lists",
    f"""WITH {STATEMENTS_SQL} SELECT item_name, section_code, array_to_string(list(year ORDER BY year), ',') AS years,
  array_to_string(list(CAST(value AS VARCHAR) ORDER BY year), ',') AS "values" FROM statements GROUP BY item_name, section_code HAVING count(*) >= 2""",
)
def trend_lists(spark, d):
    """Years and values of each item in order."""
    out = trends.series(statements(spark, d), KEYS)
    return out.select(*KEYS, F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"), F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("values"))


@query(
    "q30_rate_aggregate",
    LAGGED + """ SELECT item_name, round(avg(change_rate), 6) AS avg_rate, round(max(change_rate), 6) AS max_rate, round(min(change_rate), 6) AS min_rate, count(*) AS n
FROM yoy GROUP BY item_name HAVING count(*) >= 3""",
)
def rate_aggregate(spark, d):
    """Average, largest and smallest change of items with three changes or more."""
    t = trends.year_over_year(statements(spark, d), KEYS).groupBy("item_name")
    out = t.agg(F.avg("change_rate").alias("avg_rate"), F.max("change_rate").alias("max_rate"), F.min("change_rate").alias("min_rate"), F.count(F.lit(1)).alias("n"))
    return rounded(out.where("n >= 3"), "avg_rate", "max_rate", "min_rate")


@query(
    "d15_trend_nodes",
    LAGGED + """, ids AS (
  SELECT sha1('company|' || lower(trim(item_name)) || '|' || lower(section_code) || '|year_over_year_' || CAST(year AS VARCHAR)) AS id, change_rate FROM yoy
) SELECT id, round(change_rate, 6) AS change_rate FROM ids""",
)
def trend_nodes(spark, d):
    """Trend nodes with their ids; the year is part of the type, so years do not collapse."""
    t = trends.year_over_year(statements(spark, d), KEYS)
    key = node_id("financial_trend", company=F.lit("company"), trend_type=F.concat_ws("_", "trend_type", "year"))
    return rounded(t.select(key.alias("id"), "change_rate"), "change_rate")


@query(
    "d15_all_trends",
    f"""WITH {STATEMENTS_SQL}, v AS (SELECT item_name, section_code, year, CAST(value AS DOUBLE) AS value, row_number() OVER (PARTITION BY item_name, section_code ORDER BY year DESC) AS back,
  lag(CAST(value AS DOUBLE)) OVER (PARTITION BY item_name, section_code ORDER BY year) AS before FROM statements)
SELECT item_name, section_code, 'year_over_year' AS trend_type, year AS current_year, round(value - before, 2) AS change_amount FROM v WHERE before IS NOT NULL
UNION ALL SELECT item_name, section_code, 'overall', max(year), round(arg_max(value, year) - arg_min(value, year), 2) FROM v GROUP BY 1, 2 HAVING count(*) >= 3
UNION ALL SELECT item_name, section_code, 'recent', max(year), round(arg_max(value, year) - arg_min(value, year), 2) FROM v WHERE back <= 3 GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def all_trends(spark, d):
    """Yearly, overall and recent trends in one table, as they are loaded."""
    t = trends.all_trends(statements(spark, d), KEYS)
    return t.select(*KEYS, "trend_type", "current_year", F.round("change_amount", 2).alias("change_amount"))


@query(
    "j19_trend_data_edges",
    LAGGED + """ SELECT y.item_name, y.section_code, y.year AS trend_year, s.year AS data_year FROM yoy y JOIN statements s
  ON y.item_name = s.item_name AND y.section_code = s.section_code AND s.year IN (y.year, y.previous_year)""",
)
def trend_data_edges(spark, d):
    """Each trend's edges to the two values that it compares."""
    s = statements(spark, d)
    t = trends.year_over_year(s, KEYS).select(*KEYS, F.col("year").alias("trend_year"), F.explode(F.array("year", "previous_year")).alias("data_year"))
    return t.join(s.select(*KEYS, F.col("year").alias("data_year")), [*KEYS, "data_year"])


@query(
    "s2_years",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def years(spark, d):
    """Years that have reports."""
    return table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query(
    "s1_years_scan",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def years_scan(spark, d):
    """A scan of two years; the bounds are on the stored column, so they are pushed into the scan."""
    o = table(spark, d, "orders").where("o_orderdate >= timestamp'1996-01-01' and o_orderdate < timestamp'1998-01-01'")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s17_run_metrics",
    """WITH a AS (SELECT o_orderpriority AS operation, count(*) AS total_items, count(*) FILTER (WHERE o_orderstatus <> 'P') AS processed_items FROM orders GROUP BY 1)
SELECT operation, total_items, processed_items, total_items - processed_items AS failed_items, round(processed_items * 100.0 / total_items, 6) AS success_rate FROM a""",
)
def run_metrics(spark, d):
    """Attempted, processed and failed items of each operation."""
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("operation"))
    out = o.agg(F.count(F.lit(1)).alias("total_items"), F.count_if(F.col("o_orderstatus") != "P").alias("processed_items"))
    return out.withColumns({"failed_items": F.col("total_items") - F.col("processed_items"), "success_rate": F.round(F.col("processed_items") / F.col("total_items") * 100, 6)})
