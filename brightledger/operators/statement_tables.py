"""Statement tables in long form: one row per cell ``(table_id, row_index, col_index, column_name, text)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.functions.dictionary import best_of, found_words
from brightledger.functions.note_words import STATEMENT_COLUMNS, STATEMENT_WORDS
from brightledger.functions.text import any_of, financial_value, is_note_column, note_reference, period, trend_value

ROW = ["table_id", "row_index"]


def period_values(cells: DataFrame) -> DataFrame:
    """One row per table row: its label, the last value of each period, its note numbers, and all values as a map."""
    key = period("column_name")
    # Numbers are read only where a column is a period's.
    read = cells.select(*ROW, "col_index", "column_name", "text", key.alias("period")).withColumn("v", F.when(F.col("period").isNotNull(), financial_value("text")))
    # Ties, as of rows that repeat, go to the smaller text and the larger value.
    label = F.min(F.when(F.col("period").isNull() & ~is_note_column("column_name"), F.struct("col_index", "text")))["text"]
    out = [label.alias("item_name")]
    for p in ("current", "previous"):
        hit = (F.col("period") == p) & F.col("v").isNotNull()
        out.append(F.max(F.when(hit, F.struct("col_index", "v")))["v"].alias(f"values_{p}"))
    out.append(note_reference(F.min(F.when(is_note_column("column_name"), F.col("text")))).alias("note_numbers"))
    return read.groupBy(*ROW).agg(*out)


def values_map(cells: DataFrame) -> DataFrame:
    """Each row's printed values by column, as a map."""
    pairs = F.array_sort(F.collect_list(F.struct("col_index", "column_name", "text")))
    maps = F.map_from_entries(F.transform("__p", lambda p: F.struct(p["column_name"], p["text"])))
    return cells.groupBy(*ROW).agg(pairs.alias("__p")).select(*ROW, maps.alias("row_values"))


def row_totals(cells: DataFrame) -> DataFrame:
    """The sum of a row's numbers and its last text of more than two characters without digits; rows with neither go."""
    wordy = (F.length("text") > 2) & ~F.col("text").rlike(r"\d")
    out = cells.groupBy(*ROW).agg(
        F.sum(trend_value("text")).alias("value"), F.max_by("text", F.when(wordy, F.col("col_index"))).alias("item_name")
    )
    return out.where(F.col("value").isNotNull() & F.col("item_name").isNotNull())


def without_empty(cells: DataFrame) -> DataFrame:
    """Cells of rows and columns that hold any text."""
    filled = cells.where(F.col("text").isNotNull() & (F.trim("text") != ""))
    rows = filled.select(*ROW).distinct()
    columns = filled.select("table_id", "col_index").distinct()
    return cells.join(rows, ROW, "left_semi").join(columns, ["table_id", "col_index"], "left_semi")


def numbered_columns(columns: DataFrame) -> DataFrame:
    """Column names, blanks collapsed; a name that comes again in its table gets _1, _2 and so on."""
    clean = F.trim(F.regexp_replace("column_name", r"\s+", " "))
    again = F.row_number().over(W.partitionBy("table_id", "__clean").orderBy("col_index")) - 1
    out = columns.withColumn("__clean", clean).withColumn("__again", again)
    return out.withColumn("column_name", F.when(F.col("__again") > 0, F.concat_ws("_", "__clean", F.col("__again").cast("string"))).otherwise(F.col("__clean"))).drop("__clean", "__again")


def _distinct(column: str) -> Column:
    """How many values a column has in a table: a set for each table, where several distinct counts would copy every cell for each of them."""
    return F.size(F.collect_set(column)).cast("long")


def table_metadata(cells: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Per table: rows, columns, empty cells, share of numbers, whether a keyword occurs, and validity."""
    empty = F.col("text").isNull() | (F.trim("text") == "")
    out = cells.groupBy("table_id").agg(
        _distinct("row_index").alias("row_count"), _distinct("col_index").alias("column_count"), F.count_if(empty).alias("empty_cells"),
        F.count(F.lit(1)).alias("n_cells"), F.avg(financial_value("text").isNotNull().cast("int")).alias("numeric_ratio"),
        F.bool_or(F.coalesce(any_of(F.col("text"), keywords), F.lit(False))).alias("is_financial"),
    )
    return out.withColumns({
        "require_unit": F.col("numeric_ratio") > 0.3,
        "status": F.when(F.col("row_count") == 0, "empty").when(F.col("empty_cells") > 0.5 * F.col("n_cells"), "mostly_empty").otherwise("valid"),
    })


def column_types(cells: DataFrame, share: float = 0.8) -> DataFrame:
    """Per column: empty, numeric_string (more than ``share`` are digits) or text."""
    filled = F.col("text").isNotNull() & (F.trim("text") != "")
    digits = F.regexp_replace("text", r"[,.\s()\-]", "").rlike(r"^\d+$")
    out = cells.groupBy("table_id", "col_index").agg(F.count_if(filled).alias("n"), F.avg(F.when(filled, digits.cast("int"))).alias("ratio"))
    kind = F.when(F.col("n") == 0, "empty").when(F.col("ratio") > share, "numeric_string").otherwise("text")
    return out.select("table_id", "col_index", kind.alias("data_type"))


def inherited_units(tables: DataFrame, fragment: str, index: str, unit: str) -> DataFrame:
    """A table's unit holds for itself and for the table right after it."""
    before = F.lag(unit, 1).over(W.partitionBy(fragment).orderBy(index))
    return tables.withColumns({"unit_inherited": F.col(unit).isNull() & before.isNotNull(), "effective_unit": F.coalesce(F.col(unit), before)})


def scaled_values(cells: DataFrame, value: Column, row_unit: str | None = None, column_unit: str | None = None, table_unit: str | None = None) -> DataFrame:
    """Values in whole units: the row's unit before the column's before the table's (structs with type and multiplier)."""
    known = [F.col(u) for u in (row_unit, column_unit, table_unit) if u]
    unit = F.coalesce(*known)
    money = (unit["type"] == "money") & unit["multiplier"].isNotNull()
    # Halves go to the even number, as money is rounded here.
    return cells.withColumn("scaled", F.when(money, F.bround(value * unit["multiplier"])).otherwise(value))


def statement_index(tables: DataFrame, keywords: dict[str, Sequence[str]], key: str = "table_id", index: str = "table_index", text: str = "text") -> DataFrame:
    """Which table holds which statement: a keyword in table i names table i + 1; tables of CI are none of PL."""
    names = tables.sparkSession.createDataFrame([(c, w.replace(" ", "")) for c, ws in keywords.items() for w in ws], "section_code string, word string")
    bare = tables.select(key, (F.col(index) + 1).alias(index), F.regexp_replace(text, " ", "").alias("__bare"))
    found = bare.join(F.broadcast(names), F.col("__bare").contains(F.col("word"))).select(key, index, "section_code").distinct()
    ci = found.where("section_code = 'CI'").select(key, index)
    pl = found.where("section_code = 'PL'").join(ci, [key, index], "left_anti")
    return found.where("section_code <> 'PL'").unionByName(pl.select(found.columns))


def section_scores(tables: DataFrame, indicators: dict[str, Sequence[str]], key: str, text: str) -> DataFrame:
    """Each table's statement by the number of its words that occur; ties go to the earlier statement."""
    low = F.lower(F.col(text))
    scores = [F.struct(sum((low.contains(w).cast("int") for w in words), F.lit(0)).alias("score"), F.lit(-i).alias("order"), F.lit(code).alias("code")) for i, (code, words) in enumerate(indicators.items())]
    best = F.array_max(F.array(*scores))
    return tables.select(key, F.when(best["score"] > 0, best["code"]).alias("section_code"), best["score"].alias("score"))


def row_units(cells: DataFrame) -> DataFrame:
    """Per row: the unit of the first cell that carries a unit remark."""
    unit = F.regexp_extract("text", r"\(\s*단위\s*[:：]\s*([^)]+)\)", 1)
    marked = cells.withColumn("__unit", F.when(unit != "", F.trim(unit)))
    return marked.groupBy(*ROW).agg(F.min_by("__unit", F.when(F.col("__unit").isNotNull(), F.col("col_index"))).alias("unit")).where("unit is not null")


def table_units(cells: DataFrame, most_rows: int = 6, most_columns: int = 4, most_numbers: float = 0.2) -> DataFrame:
    """Per table: the unit of its first row, else, for small tables with few numbers, of its body."""
    unit = F.regexp_extract("text", r"\(\s*단위\s*[:：]\s*([^)]+)\)", 1)
    at = F.struct("row_index", "col_index")
    marked = cells.withColumn("__unit", F.when(unit != "", F.trim(unit)))
    has = F.col("__unit").isNotNull()
    out = marked.groupBy("table_id").agg(
        F.min_by("__unit", F.when(has & (F.col("row_index") == 0), at)).alias("head"), F.min_by("__unit", F.when(has, at)).alias("body"),
        _distinct("row_index").alias("rows"), _distinct("col_index").alias("columns"), F.avg(financial_value("text").isNotNull().cast("int")).alias("numbers"),
    )
    anchor = (F.col("rows") <= most_rows) & (F.col("columns") <= most_columns) & (F.col("numbers") < most_numbers)
    return out.select("table_id", F.coalesce("head", F.when(anchor, F.col("body"))).alias("unit"))


def table_summary(meta: DataFrame) -> DataFrame:
    """Totals, averages and the largest of all tables (one row per status)."""
    return meta.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("rows"), F.round(F.avg("column_count"), 6).alias("avg_columns"), F.max(F.struct("row_count", (-F.col("table_id")).alias("t"))).alias("__m")
    ).withColumn("largest", -F.col("__m.t")).drop("__m")


def note_link_statistics(links: DataFrame, section: str, note: str) -> DataFrame:
    """Links by section: how many, and to how many notes."""
    return links.groupBy(section).agg(F.count(F.lit(1)).alias("links"), F.count_distinct(note).alias("notes"))


def most_linked(links: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The ``n`` values of a column with most links; of equals, the smaller ones."""
    return links.groupBy(column).agg(F.count(F.lit(1)).alias("links")).orderBy(F.desc("links"), column).limit(n)


def out_of_order(df: DataFrame, key: str, pos: str, number: str) -> DataFrame:
    """Numbered sections whose number is smaller than that before it."""
    before = F.lag(number).over(W.partitionBy(key).orderBy(pos))
    return df.withColumn("previous_number", before).where(F.col("previous_number") > F.col(number))


def inherits_unit(cells: DataFrame, currency: Sequence[str], keywords: Sequence[str], first_rows: int = 5, share: float = 0.15) -> DataFrame:
    """Whether a table without a unit should take the one before: it has numbers, a currency word near its top, or is financial."""
    top = F.col("row_index") < first_rows
    word = any_of(F.lower(F.concat_ws(" ", "column_name", "text")), currency)
    out = cells.groupBy("table_id").agg(
        F.avg(financial_value("text").isNotNull().cast("int")).alias("numbers"), F.bool_or(top & word).alias("currency"), F.bool_or(F.coalesce(any_of(F.col("text"), keywords), F.lit(False))).alias("financial")
    )
    return out.select("table_id", ((F.col("numbers") >= share) | F.col("currency") | F.col("financial")).alias("inherits"))


def extraction_statistics(tables: DataFrame, title: str, is_financial: str, references: str, code: str) -> DataFrame:
    """Per section title: tables, financial tables, note references and distinct statements."""
    return tables.groupBy(title).agg(
        F.count(F.lit(1)).alias("tables"), F.count_if(is_financial).alias("financial_tables"), F.sum(references).alias("references"), F.count_distinct(code).alias("codes")
    )


#: Words of columns and contents that mark a table as financial (fixed values).
FINANCIAL_WORDS = (
    "과 목", "계정과목", "항목", "구분", "당기", "전기", "기말", "기초", "금액", "원", "백만원", "천원", "자산", "부채", "자본", "수익", "비용", "이익",
    "매출", "현금", "투자", "차입", "포괄손익", "기타포괄손익", "자본변동", "이익잉여금", "주식발행", "영업활동", "투자활동", "재무활동", "현금흐름", "손익계산", "포괄손익계산",
)


def looks_financial(cells: DataFrame, words: Sequence[str] = FINANCIAL_WORDS, key: Sequence[str] = ("table_id",)) -> DataFrame:
    """Per table: whether a column or a cell has one of the words, or more than a fifth of the cells have figures."""
    named = F.bool_or(any_of(F.col("column_name"), words) | any_of(F.lower("text"), words))
    figures = F.avg(F.coalesce(F.col("text").rlike("[0-9,()]"), F.lit(False)).cast("int")) > 0.2
    return cells.groupBy(*key).agg((F.coalesce(named, F.lit(False)) | figures).alias("financial"))


def texts_financial(texts: Column, words: Sequence[str] = FINANCIAL_WORDS) -> Column:
    """What ``looks_financial`` says of a table without names of columns whose texts are one array."""
    named = F.exists(texts, lambda t: any_of(F.lower(t), words))
    figures = F.try_divide(F.size(F.filter(texts, lambda t: t.rlike("[0-9,()]"))), F.size(texts)) > 0.2
    return F.coalesce(named, F.lit(False)) | F.coalesce(figures, F.lit(False))


def statements_of_tables(
    cells: DataFrame, words: dict[str, Sequence[str]] = STATEMENT_WORDS, columns: Sequence[tuple] = STATEMENT_COLUMNS, key: Sequence[str] = ("table_id",)
) -> DataFrame:
    """Per table of cells: ``section_code, score``: the statement most of whose words its texts contain, the first of equals.

    Cells are put together in order of rows and columns, one blank between. Where no word occurs, the names of the columns
    decide: the first statement each of whose groups of words has one there, score 0; else the code is empty.
    """
    at = F.struct("row_index", "col_index", "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), at))), lambda c: c["text"]), " ")
    # Column names are few and repeat in each row, so they are a set.
    names = F.array_join(F.array_sort(F.collect_set("column_name")), " ")
    tables = cells.groupBy(*key).agg(text.alias("__text"), names.alias("__names"))
    every = [w for ws in words.values() for w in ws]
    read = tables.withColumns({"__found": found_words("__text", every), "__named": found_words("__names", [w for _, groups in columns for ws in groups for w in ws])})
    best = best_of("__found", words)
    by_name = F.when(F.lit(False), "")
    for code, groups in columns:
        has = F.lit(True)
        for ws in groups:
            has = has & F.arrays_overlap("__named", F.array(*map(F.lit, ws)))
        by_name = by_name.when(has, code)
    code = F.when(best["hits"] > 0, best["name"]).otherwise(by_name.otherwise(""))
    return read.select(*key, code.alias("section_code"), best["hits"].alias("score"))
