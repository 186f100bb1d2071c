"""Texts of a table are never sorted with each of its cells, and cells are not copied for distinct counts."""

import re

from brightledger.operators import statement_tables, units


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def cells(spark):
    rows = [(1, t, r, c, "과목", "(단위: 천원)" if (r, c) == (-1, 0) else f"{r}", r < 0) for t in (1, 2) for r in (-1, 0, 0, 1) for c in (0, 1)]
    return spark.createDataFrame(rows, "fragment long, table_index long, row_index long, col_index int, column_name string, text string, is_head boolean")


def test_cells_are_sorted_once_and_bare(spark):
    found = units.resolved_units(cells(spark))
    assert len(re.findall(r"\bSort \[", plan(found))) == 1
    assert {r.unit.unit for r in found.collect()} == {"천원"}


def test_sizes_of_tables_without_copies(spark):
    c = cells(spark).withColumnRenamed("table_index", "table_id")
    for found in (statement_tables.table_metadata(c, ("x",)), statement_tables.table_units(c)):
        assert "Expand" not in plan(found)
    r = statement_tables.table_metadata(c, ("x",)).first()
    assert (r.row_count, r.column_count, r.n_cells) == (3, 2, 8)
