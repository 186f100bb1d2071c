"""Summaries over the statement data."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.plans.registry import query
from brightledger.sources.tables import STATEMENT_ROWS_SQL, STATEMENTS_SQL, statement_rows, statements, table

ROWS = f"WITH {STATEMENT_ROWS_SQL} "
FACTS = f"WITH {STATEMENTS_SQL} "


@query("q16_year_metrics", ROWS + "SELECT section_code, count(DISTINCT item_name) AS items, CAST(sum(amount) AS DOUBLE) AS total FROM statement_rows WHERE year = 1997 GROUP BY 1")
def year_metrics(spark, d):
    """A year's items and sums by section."""
    g = statement_rows(spark, d).where("year = 1997").groupBy("section_code")
    return g.agg(F.count_distinct("item_name").alias("items"), F.sum("amount").cast("double").alias("total"))


@query("q16_top_paths", ROWS + "SELECT section_code || '>' || item_name || '>' || brand AS path, CAST(sum(amount) AS DOUBLE) AS total FROM statement_rows WHERE year = 1997 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_paths(spark, d):
    """A year's ten largest paths."""
    g = statement_rows(spark, d).where("year = 1997").groupBy(F.concat_ws(">", "section_code", "item_name", "brand").alias("path"))
    return g.agg(F.sum("amount").cast("double").alias("total")).orderBy(F.desc("total"), "path").limit(10)


@query(
    "a20_year_summary",
    FACTS + """, t AS (SELECT section_code, year, count(DISTINCT item_name) AS items, CAST(sum(value) AS DOUBLE) AS total FROM statements GROUP BY 1, 2)
SELECT b.section_code, b.year, b.items, b.total, round(CASE WHEN a.total > 0 THEN (b.total - a.total) / a.total * 100 ELSE 0 END, 6) AS change_rate FROM t b LEFT JOIN t a ON a.section_code = b.section_code AND a.year + 1 = b.year""",
)
def year_summary(spark, d):
    """Items, sums and change by section and year."""
    t = statements(spark, d).groupBy("section_code", "year").agg(F.count_distinct("item_name").alias("items"), F.sum("value").cast("double").alias("total"))
    a = t.select("section_code", (F.col("year") + 1).alias("year"), F.col("total").alias("before"))
    rate = F.when(F.col("before") > 0, (F.col("total") - F.col("before")) / F.col("before") * 100).otherwise(0.0)
    return t.join(a, ["section_code", "year"], "left").withColumn("change_rate", F.round(rate, 6)).drop("before")


@query("q18_section_statistics", ROWS + "SELECT section_code, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total, min(year) AS first_year, max(year) AS last_year FROM statement_rows GROUP BY 1")
def section_statistics(spark, d):
    """Count, sum and years of each section."""
    g = statement_rows(spark, d).groupBy("section_code")
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@query("q20_grouping_sets", ROWS + "SELECT year, section_code, CAST(grouping(year, section_code) AS BIGINT) AS \"grouping\", count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM statement_rows GROUP BY GROUPING SETS ((year, section_code), (year), (section_code), ())")
def grouping_sets(spark, d):
    """Sums by year and section, year, section and in all, in one pass."""
    r = statement_rows(spark, d).groupingSets([["year", "section_code"], ["year"], ["section_code"], []], "year", "section_code")
    return r.agg(F.grouping_id().alias("grouping"), F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"))


@query("d20_section_shares", FACTS + "SELECT year, section_code, round(CAST(sum(value) AS DOUBLE) / CAST(sum(sum(value)) OVER (PARTITION BY year) AS DOUBLE) * 100, 6) AS share FROM statements GROUP BY 1, 2")
def section_shares(spark, d):
    """Each section's share of its year."""
    t = statements(spark, d).groupBy("year", "section_code").agg(F.sum("value").alias("v"))
    share = F.col("v").cast("double") / F.sum("v").over(W.partitionBy("year")).cast("double") * 100
    return t.select("year", "section_code", F.round(share, 6).alias("share"))


@query("q24_overview", FACTS + "SELECT count(*) AS values, count(DISTINCT item_name) AS items, count(DISTINCT section_code) AS sections, min(year) AS first_year, max(year) AS last_year FROM statements")
def overview(spark, d):
    """What the store holds."""
    return statements(spark, d).agg(
        F.count(F.lit(1)).alias("values"), F.count_distinct("item_name").alias("items"), F.count_distinct("section_code").alias("sections"), F.min("year").alias("first_year"), F.max("year").alias("last_year")
    )


@query("q28_level_one_summary", ROWS + "SELECT section_code, item_name, CAST(sum(amount) AS DOUBLE) AS total, count(DISTINCT year) AS years FROM statement_rows GROUP BY 1, 2")
def level_one_summary(spark, d):
    """Sums of the first level of each section."""
    g = statement_rows(spark, d).groupBy("section_code", "item_name")
    return g.agg(F.sum("amount").cast("double").alias("total"), F.count_distinct("year").alias("years"))


@query("q31_filtered_sums", ROWS + "SELECT priority, CAST(coalesce(sum(CASE WHEN section_code IN ('A', 'R') THEN amount END), 0) AS DOUBLE) AS returned, CAST(coalesce(sum(CASE WHEN year < 1990 THEN amount END), 0) AS DOUBLE) AS early FROM statement_rows GROUP BY 1")
def filtered_sums(spark, d):
    """Sums under conditions; nothing sums to zero."""
    def part(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("amount"))).cast("double"), F.lit(0.0))

    g = statement_rows(spark, d).groupBy("priority")
    return g.agg(part(F.col("section_code").isin("A", "R")).alias("returned"), part(F.col("year") < 1990).alias("early"))


@query("p5_optional_filters", FACTS + "SELECT item_name, section_code, year, CAST(value AS DOUBLE) AS value FROM statements WHERE year = 1997 AND section_code = 'A'")
def optional_filters(spark, d):
    """Rows under the filters that are given."""
    return filtered(statements(spark, d), year=1997, section_code="A", brand=None).withColumn("value", F.col("value").cast("double"))


def filtered(df, **equal):
    """Rows whose columns equal the given values; None asks nothing."""
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


@query("q17_data_model", "SELECT 'orders' AS label, count(*) AS n, count(DISTINCT o_orderstatus) AS kinds FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_returnflag) FROM lineitem UNION ALL SELECT 'events', count(*), count(DISTINCT event_type) FROM events")
def data_model(spark, d):
    """Tables with their sizes and kinds."""
    parts = [("orders", "o_orderstatus"), ("lineitem", "l_returnflag"), ("events", "event_type")]
    frames = [table(spark, d, t).agg(F.lit(t).alias("label"), F.count(F.lit(1)).alias("n"), F.count_distinct(c).alias("kinds")) for t, c in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("a2_volatility", "SELECT user_id, round(coalesce(stddev_samp(value), 0), 6) AS volatility, count(*) AS n FROM events GROUP BY 1")
def event_volatility(spark, d):
    """Sample deviation of each user's values, zero for a single one."""
    from brightledger.operators.trends import volatility

    return table(spark, d, "events").groupBy("user_id").agg(F.round(volatility("value"), 6).alias("volatility"), F.count(F.lit(1)).alias("n"))


@query("o3_ordered_lists", "SELECT user_id, string_agg(event_type, '>' ORDER BY ts, event_id) AS path FROM events GROUP BY 1")
def ordered_lists(spark, d):
    """Each user's events in order."""
    pairs = F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type")))
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.transform(pairs, lambda p: p["event_type"]), ">").alias("path"))
