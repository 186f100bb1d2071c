"""Units of statement cells: all places that may name one, in their order of precedence.

A cell's unit is that of its row, if a cell of the row carries a remark ``(단위: ...)``; else the one that its column's name
hints at; else the table's: of its caption and head, or, for small tables with few figures, of its body; else that
of the table right before it. Of several units in one remark the first one of money is meant, else the first. All of that are
windows over cells dealt by the fragment of the page, so resolving takes one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.functions.text import any_of, units

# --- fixed values: hints of column names, and what a small table is
PERCENT_HINTS, SHARE_HINTS = ("율", "ratio", "margin"), ("주식수", "shares", "주식", "주")
ANCHOR_ROWS, ANCHOR_COLUMNS, ANCHOR_NUMBERS, NEEDS_UNIT = 6, 4, 0.2, 0.3
UNIT = "struct<unit: string, type: string, multiplier: bigint, source: string>"


def main_unit(text: Column, source: str) -> Column:
    """The unit that the first remark of a text means: its first one of money, else its first."""
    every = units(text)
    meant = F.coalesce(F.get(F.filter(every, lambda u: u["type"] == "money"), F.lit(0)), F.get(every, F.lit(0)))
    return F.when(meant.isNotNull(), F.struct(meant["unit"].alias("unit"), meant["type"].alias("type"), meant["multiplier"].alias("multiplier"), F.lit(source).alias("source")).cast(UNIT))


def column_unit(name: Column) -> Column:
    """What a column's name hints at: percentages or shares."""
    bare = F.lower(F.regexp_replace(name, " ", ""))

    def hint(unit: str, kind: str, factor: int | None) -> Column:
        return F.struct(F.lit(unit).alias("unit"), F.lit(kind).alias("type"), F.lit(factor).cast("bigint").alias("multiplier"), F.lit("column").alias("source")).cast(UNIT)

    return F.when(name.contains("%") | any_of(bare, PERCENT_HINTS), hint("%", "percent", None)).when(any_of(bare, SHARE_HINTS), hint("주", "shares", 1))


def is_figure(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, "[,.]", "").rlike(r"^\d+$"), F.lit(False))


def resolved_units(cells: DataFrame, fragment: str = "fragment", index: str = "table_index", head: str = "is_head") -> DataFrame:
    """Adds ``unit`` (of the cell, with its source), ``table_unit``, ``needs_unit`` and ``unit_inherited`` to cells.

    Cells are ``(fragment, table_index, row_index, col_index, column_name, text, is_head)``; captions and head cells are marked,
    and are no rows of the table. Heads and bodies are read in the order of rows and columns.
    """
    table, row = [fragment, index], [fragment, index, "row_index"]
    at = F.struct("row_index", "col_index", "text")
    body = ~F.col(head)

    def joined(some: Column, over) -> Column:
        listed = F.array_sort(F.collect_list(F.when(some & F.col("text").isNotNull(), at)).over(over))
        return F.array_join(F.transform(listed, lambda c: c["text"]), " \n ")

    whole = W.partitionBy(*table)
    carried = F.when(body, main_unit(F.col("text"), "row"))
    first_carried = F.min(F.when(carried.isNotNull(), F.struct("col_index", carried.alias("u")))).over(W.partitionBy(*row))["u"]
    in_row = F.when(body & F.col("row_index").isNotNull(), F.lit(1))
    # One deal and one sort of the bare cells serve all windows: rows come first, as their order is that of tables and fragments too, and
    # what is put together of a table's texts passes through and is never sorted.
    read = cells.repartition(fragment).withColumns({"__row": first_carried, "__share": in_row / F.count(in_row).over(W.partitionBy(*row))})
    numbers = F.avg(F.when(body, is_figure(F.col("text")).cast("int"))).over(whole)
    rows = F.round(F.sum("__share").over(whole))
    columns = F.size(F.collect_set(F.when(body, F.col("col_index"))).over(whole))
    small = (F.coalesce(rows, F.lit(0)) <= ANCHOR_ROWS) & (columns <= ANCHOR_COLUMNS) & (numbers < ANCHOR_NUMBERS)
    read = read.withColumns({"__small": small, "needs_unit": F.coalesce(numbers > NEEDS_UNIT, F.lit(False))})
    # Bodies are put together for small tables alone.
    read = read.withColumns({"__head": main_unit(joined(F.col(head), whole), "table"), "__body": joined(body & F.col("__small"), whole)})
    own = F.coalesce("__head", F.when(F.col("__small"), main_unit(F.col("__body"), "table")))
    read = read.withColumn("__own", own)
    # The table before is the last other one in the fragment's order, whose own unit comes with each of its cells.
    before = F.last(F.struct(F.col(index).alias("i"), F.col("__own").alias("u"))).over(W.partitionBy(fragment).orderBy(index).rangeBetween(W.unboundedPreceding, -1))
    read = read.withColumn("__before", before["u"])
    table_unit = F.coalesce("__own", F.when(F.col("__before").isNotNull(), F.col("__before").withField("source", F.lit("inherited"))))
    inherited = F.col("__own").isNull() & F.col("__before").isNotNull()
    unit = F.coalesce("__row", column_unit(F.col("column_name")), table_unit)
    return read.withColumns({"table_unit": table_unit, "unit": unit, "unit_inherited": inherited}).drop("__row", "__share", "__head", "__body", "__small", "__own", "__before")


def in_whole_units(value: Column, unit: Column) -> Column:
    """A value in whole units of money, or as it is for other units; halves go to the even number."""
    factor = F.when(unit["type"] == "money", F.coalesce(unit["multiplier"], F.lit(1))).otherwise(1)
    return F.bround(value * factor).cast("long")
