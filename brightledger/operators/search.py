"""Search documents from sections, notes and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.functions.text import search_text


def documents(df: DataFrame, doc_type: str, title: str, content: str, anchor: str, year: str, least: int, most_title: int = 500, most: int = 10_000, keep: Sequence[str] = ()) -> DataFrame:
    """One search document per row whose cleaned content is long enough, with the columns to ``keep``."""
    clean = search_text(content, most)
    out = df.select(
        F.lit(doc_type).alias("doc_type"), F.substring(title, 1, most_title).alias("title"), clean.alias("content"), F.col(anchor).cast("string").alias("anchor"), F.col(year).alias("year"), *keep
    ).where(F.length("content") >= least)
    words = F.size(F.filter(F.split("content", " "), lambda w: w != ""))
    return out.withColumns({"content_length": F.length("content"), "word_count": words})


def statistics(docs: DataFrame, by: str = "doc_type") -> DataFrame:
    """Counts and average sizes by type, or by another column."""
    return docs.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg("content_length").alias("avg_length"), F.avg("word_count").alias("avg_words"), F.max("content_length").alias("longest"))


def largest(docs: DataFrame, n: int = 5) -> DataFrame:
    """The longest documents; of equals, those first in order of type and anchor."""
    return docs.orderBy(F.desc("content_length"), "doc_type", "anchor").limit(n)
