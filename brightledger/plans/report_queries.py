"""Report pages: decoding, cleaning, blocks, sections and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.operators import reports as R
from brightledger.plans.registry import query
from brightledger.sources.tables import table


def _heading():
    return F.col("tag").isin("h1", "h2", "h3")


@query("s3_decoded_pages", "SELECT page_id, sha256(html) AS text_sha256 FROM pages")
def decoded_pages(spark, d):
    """Page bytes decoded by the first encoding that fits."""
    p = table(spark, d, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return p.select("page_id", F.sha2(R.decoded("content", ("ascii", "utf-8")), 256).alias("text_sha256"))


@query(
    "h2_cleaned_pages",
    """SELECT page_id, length(regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)\\b[^>]*>.*?</(script|style)\\s*>', '', 'gis'), '<(meta|link)\\b[^>]*>', '', 'gi'), '(<br\\s*/?>\\s*){2,}', '<br>', 'gi')) AS n FROM pages""",
)
def cleaned_pages(spark, d):
    """Pages without scripts, styles and empty layout."""
    return table(spark, d, "pages").select("page_id", F.char_length(R.cleaned("html")).cast("long").alias("n"))


@query(
    "h5_titles",
    r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS title FROM pages""",
)
def titles(spark, d):
    """Page titles, references decoded."""
    p = table(spark, d, "pages")
    b = R.blocks(p).where("tag = 'title'").groupBy("page_id").agg(F.min_by("text", "pos").alias("title"))
    return p.select("page_id").join(b, "page_id", "left").withColumn("title", F.coalesce("title", F.lit("")))


@query(
    "h11_table_cells",
    """WITH l AS (SELECT l_orderkey AS page_id, l_partkey, l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 AS r FROM lineitem)
SELECT page_id, 0 AS table_index, CAST(r AS INTEGER) AS row_index, 0 AS col_index, 'part ' || CAST(l_partkey AS VARCHAR) AS text FROM l
UNION ALL SELECT page_id, 0, CAST(r AS INTEGER), 2, l_returnflag FROM l""",
)
def table_cells(spark, d):
    """The cells of tables in pages, a page and a table for each order: cells wrapped in paragraphs, the first one two columns wide."""
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def printed(x):
        return F.concat(F.lit('<tr><td colspan="2"><p><b>part</b> '), x["l_partkey"].cast("string"), F.lit("</p></td><td><div><p>"), x["l_returnflag"], F.lit("</p></div></td></tr>"))

    html = F.concat(F.lit("<h2>Lines</h2><table>"), F.array_join(F.transform("rows", printed), "\n"), F.lit("</table><p>End</p>"))
    cells = R.blocks(lines.select("page_id", html.alias("html"))).where("table_index is not null")
    return cells.select("page_id", "table_index", "row_index", "col_index", "text")


@query("h8_sections")
def page_sections(spark, d):
    """Titles and contents of the sections of each page."""
    numbered = R.sections(R.blocks(table(spark, d, "pages")), _heading())
    return R.section_contents(numbered, _heading())


@query("v6_section_issues")
def section_issues(spark, d):
    """What the sections of the pages lack."""
    return R.section_issues(page_sections(spark, d)).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("a19_quality_scores")
def quality_scores(spark, d):
    """A score for how completely each page was read."""
    s = page_sections(spark, d)
    tables = R.table_status(R.blocks(table(spark, d, "pages")).where("table_index is not null"))
    return R.quality_score(s, R.section_issues(s), 2, tables).select("page_id", F.round("score", 6).alias("score"))


@query("h24_block_counts", "SELECT page_id, len(regexp_extract_all(html, '<li>')) AS items FROM pages")
def block_counts(spark, d):
    """List items per page, counted on the blocks."""
    p = table(spark, d, "pages")
    b = R.blocks(p).where("tag = 'li'").groupBy("page_id").agg(F.count(F.lit(1)).alias("items"))
    return p.select("page_id").join(b, "page_id", "left").na.fill(0, ["items"])
