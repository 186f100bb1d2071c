"""Tables kept by year, a folder for each, so that a read of some years lists and scans those alone.

Years that a reader names are a filter of the plan, seen before anything is listed; years that only data tell (those of the reports
that another table speaks of) prune the scan while the query runs, by the join with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_yearly(df: DataFrame, path: str, year: str = "year") -> None:
    """Rows as Parquet, a folder per year; only the years that there are rows of are replaced."""
    dealt = df.hint("rebalance", year)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def read_yearly(spark: SparkSession, path: str, years: Sequence[int] | DataFrame | None = None, year: str = "year") -> DataFrame:
    """The rows of some years: all, those of a list, or those in a table's first column. Years that are not there are absent."""
    rows = spark.read.parquet(path)
    if years is None:
        return rows
    if isinstance(years, DataFrame):
        # Distinct years are a handful, whatever the table.
        wanted = years.select(F.col(years.columns[0]).cast(rows.schema[year].dataType).alias(year)).distinct()
        return rows.join(F.broadcast(wanted), year)
    return rows.where(F.col(year).isin(list(years)))


def available_years(spark: SparkSession, path: str, year: str = "year") -> DataFrame:
    """The years that there are, from the folders' names alone."""
    return spark.read.parquet(path).select(year).distinct()

