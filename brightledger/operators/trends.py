"""Trends of a value over years, per item and section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STABLE = 5.0  # percent


def direction(rate: Column, threshold: float = STABLE) -> Column:
    return F.when(rate > threshold, "increasing").when(rate < -threshold, "decreasing").otherwise("stable")


def change(current: Column, previous: Column) -> dict[str, Column]:
    """Amount, rate in percent of the previous value's size, and direction."""
    amount = current - previous
    rate = F.when(previous == 0, 100.0 * F.signum(current)).otherwise(amount / F.abs(previous) * 100)
    return {"change_amount": amount, "change_rate": rate, "trend_direction": direction(rate)}


def growth_rate(value: str, year: str) -> Column:
    """Compound growth over the positive values, in percent; 0 with fewer than two of them (an aggregate)."""
    v, positive = F.col(value), F.col(value) > 0
    n = F.count_if(positive) - 1
    first = F.min_by(F.when(positive, v), F.when(positive, F.col(year)))
    last = F.max_by(F.when(positive, v), F.when(positive, F.col(year)))
    return F.when(n >= 1, (F.pow(last / first, 1 / n) - 1) * 100).otherwise(0.0)


def volatility(value: str) -> Column:
    """Sample deviation, 0 for fewer than two values (an aggregate)."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def year_over_year(df: DataFrame, keys: Sequence[str], year: str = "year", value: str = "value") -> DataFrame:
    """Each observation against the previous one of its key; first observations and nulls are left out."""
    w = W.partitionBy(*keys).orderBy(year)
    seen = df.where(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    lagged = seen.withColumns({"previous_value": F.lag(value).over(w), "previous_year": F.lag(year).over(w)})
    both = lagged.where(F.col("previous_value").isNotNull()).withColumnRenamed(value, "current_value")
    return both.withColumns(change(F.col("current_value"), F.col("previous_value"))).withColumn("trend_type", F.lit("year_over_year"))


def overall(df: DataFrame, keys: Sequence[str], year: str = "year", value: str = "value", least: int = 3) -> DataFrame:
    """Growth, deviation and change over all observations of a key with at least ``least`` of them."""
    seen = df.where(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    out = seen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(year).alias("previous_year"), F.max(year).alias("current_year"),
        F.min_by(value, year).alias("previous_value"), F.max_by(value, year).alias("current_value"),
        growth_rate(value, year).alias("growth_rate"), volatility(value).alias("volatility"),
    )
    out = out.where(F.col("n") >= least)
    return out.withColumns({
        "change_amount": F.col("current_value") - F.col("previous_value"),
        "trend_direction": direction(F.col("growth_rate")),
        "trend_type": F.lit("overall"),
    })


def recent(df: DataFrame, keys: Sequence[str], year: str = "year", value: str = "value", last: int = 3) -> DataFrame:
    """The overall trend of each key's last ``last`` observations."""
    seen = df.where(F.col(value).isNotNull())
    ranked = seen.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(year))))
    newest = ranked.where(F.col("__rank") <= last).drop("__rank")
    return overall(newest, keys, year, value, last).withColumn("trend_type", F.lit("recent"))


def all_trends(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes from year to year, the overall and the recent trends of every key in one table."""
    yearly = year_over_year(df, keys).withColumnRenamed("year", "current_year")
    parts = [yearly, overall(df, keys), recent(df, keys)]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


def statistics(trends: DataFrame) -> DataFrame:
    """Counts by type and direction."""
    return trends.groupBy("trend_type").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("trend_direction") == d).alias(d) for d in ("increasing", "decreasing", "stable")],
    )


def pair_growth(
    df: DataFrame, on: Sequence[str], first: int, second: int, year: str = "year", value: str = "value", least: float = 0.0, top: int | None = None
) -> DataFrame:
    """Growth between two years for every key; a base that is not positive counts as no growth."""
    a = df.where(F.col(year) == first).select(*on, F.col(value).cast("double").alias("first_value"))
    b = df.where(F.col(year) == second).select(*on, F.col(value).cast("double").alias("second_value"))
    grown = F.when(F.col("first_value") > 0, (F.col("second_value") - F.col("first_value")) / F.col("first_value") * 100).otherwise(0.0)
    out = a.join(b, list(on)).withColumn("growth_rate", grown).where(F.abs("growth_rate") > least)
    return out if top is None else out.orderBy(F.desc(F.abs("growth_rate")), *on).limit(top)


def adjacent_growth(df: DataFrame, on: Sequence[str], year: str = "year", value: str = "value", least: float = 5.0) -> DataFrame:
    """Growth against the calendar year before, where it exceeds ``least`` percent either way."""
    before = df.select(*on, (F.col(year) + 1).alias(year), F.col(value).cast("double").alias("previous_value"))
    now = df.select(*on, year, F.col(value).cast("double").alias("current_value"))
    both = now.join(before, [*on, year]).where(F.col("previous_value") > 0)
    rate = (F.col("current_value") - F.col("previous_value")) / F.col("previous_value") * 100
    return both.withColumn("growth_rate", rate).where(F.abs("growth_rate") > least)


def consecutive_years(df: DataFrame, section: str = "section_code", year: str = "year") -> DataFrame:
    """An edge from each year of a section to the next one that it has; gaps are bridged."""
    years = df.select(section, year).distinct()
    nxt = F.lead(year).over(W.partitionBy(section).orderBy(year))
    return years.withColumn("next_year", nxt).where(F.col("next_year").isNotNull())


def series(df: DataFrame, keys: Sequence[str], year: str = "year", value: str = "value", least: int = 2) -> DataFrame:
    """Years and values of each key as lists in order of years."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(year).alias("y"), F.col(value).alias("v"))))
    out = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(pairs.alias("__p")).where(F.size("__p") >= least)
    return out.select(*keys, F.transform("__p", lambda p: p["y"]).alias("years"), F.transform("__p", lambda p: p["v"]).alias("values"))
