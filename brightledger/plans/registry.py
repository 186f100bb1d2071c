"""Every registered query of the statement-graph library, with its SQL."""

from __future__ import annotations

import importlib

#: Modules with queries; each uses ``query`` below.
MODULES = (
    "trend_queries", "graph_queries", "hierarchy_queries", "relation_queries", "text_queries", "note_queries", "summary_queries", "report_queries", "coverage_queries",
    "tree_queries", "dictionary_queries", "merge_queries", "load_queries", "mixed_queries", "report_load_queries", "detail_queries", "store_queries",
)
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``f(spark, folder)`` under a name, with the SQL that it must agree with."""

    def register(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"brightledger.plans.{module}")


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def described(word: str = "") -> list[tuple[str, str]]:
    """Names and first lines of the registered queries whose name or description has the word."""
    found = ((name, (f.__doc__ or "").strip().partition("\n")[0]) for name, f in queries().items())
    return [(n, d) for n, d in found if word.lower() in f"{n} {d}".lower()]
