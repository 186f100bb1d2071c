"""Cells and records of mixed kinds as VARIANT values: text, numbers, nothing, note references, nested sections.

A cell keeps its kind through JSON and back; readers ask a value for what they need of it, and get null where it is of another kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.text import is_note_column, stripped

#: A strict list of note numbers (fixed value).
NOTE_LIST = r"^\d+(?:,\s*\d+)*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _object(*fields: Column) -> Column:
    return F.to_variant_object(F.struct(*fields))


def note_cell(text: Column | str) -> Column:
    """A cell of a note column: ``{type: notes_reference, note_numbers, original_value, reference_count}`` for a list of numbers, else ``{type: text, value}``."""
    t = stripped(text)
    numbers = F.transform(F.split(t, ","), lambda n: stripped(n).try_cast("int"))
    numbered = t.rlike(NOTE_LIST) & ~F.exists(numbers, lambda n: n.isNull())
    reference = _object(F.lit("notes_reference").alias("type"), numbers.alias("note_numbers"), t.alias("original_value"), F.size(numbers).alias("reference_count"))
    return F.when(t.isNotNull(), F.when(numbered, reference).otherwise(_object(F.lit("text").alias("type"), t.alias("value"))))


def cell(text: Column | str, column_name: Column | str | None = None) -> Column:
    """A cell as a variant: a number where its text is one (separators of thousands allowed), else its text; null for blanks.

    Cells of note columns are note cells.
    """
    t = stripped(text)
    number = F.regexp_replace(t, ",", "").try_cast("double")
    plain = F.when((t == "") | t.isNull(), None).when(t.rlike(r"^-?\d[\d,]*$") & (F.length(t) < 18), F.regexp_replace(t, ",", "").try_cast("long").cast("variant"))
    plain = plain.when(t.rlike(r"^-?\d[\d,]*(?:\.\d+)?$"), number.cast("variant")).otherwise(t.cast("variant"))
    if column_name is None:
        return plain
    return F.when(is_note_column(column_name), note_cell(text)).otherwise(plain)


def kind(value: Column | str) -> Column:
    """``text``, ``number``, ``boolean``, ``notes``, ``list``, ``object`` or ``null``."""
    v = _c(value)
    of = F.schema_of_variant(v)
    tagged = F.try_variant_get(v, "$.type", "string") == "notes_reference"
    return (
        F.when(v.isNull() | F.is_variant_null(v), "null").when(of.startswith("OBJECT"), F.when(tagged, "notes").otherwise("object")).when(of.startswith("ARRAY"), "list")
        .when(of == "STRING", "text").when(of == "BOOLEAN", "boolean").otherwise("number")
    )


def text_of(value: Column | str) -> Column:
    """A cell's text: as it is, the one that a note cell holds, or null for other kinds."""
    v = _c(value)
    of = F.schema_of_variant(v)
    inner = F.coalesce(F.try_variant_get(v, "$.value", "string"), F.try_variant_get(v, "$.original_value", "string"))
    return F.when(of == "STRING", F.try_variant_get(v, "$", "string")).when(of.startswith("OBJECT"), inner)


def number_of(value: Column | str) -> Column:
    v = _c(value)
    return F.when(kind(v) == "number", F.try_variant_get(v, "$", "double"))


def notes_of(value: Column | str) -> Column:
    """``array<int>``: the notes that a cell refers to, null if it is no reference."""
    return F.try_variant_get(_c(value), "$.note_numbers", "array<int>")


def strings_of(value: Column | str) -> Column:
    """``array<string>`` of anything: a text alone, each element of a list, or all as JSON; what is no text as JSON, blanks left out, null for nothing."""
    v = _c(value)

    def one(e: Column) -> Column:
        return F.when(e.isNull() | F.is_variant_null(e), None).when(F.schema_of_variant(e) == "STRING", stripped(F.try_variant_get(e, "$", "string"))).otherwise(F.to_json(e))

    parts = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.transform(F.try_variant_get(v, "$", "array<variant>"), one)).otherwise(F.array(one(v)))
    kept = F.filter(parts, lambda s: s.isNotNull() & (s != ""))
    return F.when(F.size(kept) > 0, kept)


def flattened(reports: DataFrame, key: str, report: str, sections: str = "sections", children: str = "subsections", most: int = 50) -> DataFrame:
    """Sections of any depth as rows, in order: ``key, path, level, title, content``; ``path`` holds each ancestor's place.

    One step per level, until a level has none; each step explodes what the one before holds. More than ``most`` levels are an error.
    """

    def inside(of: Column, name: str) -> Column:
        return F.posexplode(F.try_variant_get(of, f"$.{name}", "array<variant>")).alias("i", "s")

    found, level = None, reports.select(key, F.array().cast("array<int>").alias("path"), inside(F.col(report), sections))
    for _ in range(most):
        level = level.select(key, F.array_append("path", F.col("i")).alias("path"), "s")
        found = level if found is None else found.unionByName(level)
        level = level.select(key, "path", inside(F.col("s"), children))
        if level.isEmpty():
            break
    else:
        raise ValueError(f"sections are nested more than {most} times")
    return found.select(key, "path", F.size("path").alias("level"), *[F.try_variant_get("s", f"$.{c}", "string").alias(c) for c in ("title", "content")])
