"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from brightledger.llm import (
    decontaminate, exact_dedup, fingerprints, html_extract, line_dedup, packing, quality, resampling, simhash, substring_dedup, suffix_dedup, warc, whitening,
)

MODULES = (suffix_dedup, quality, simhash, line_dedup, html_extract, packing, substring_dedup, decontaminate, exact_dedup, warc, fingerprints, whitening, resampling)


def queries() -> dict:
    return {name: f for module in MODULES for name, f in vars(module).items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict:
    return {name: module.SQL for module in MODULES if hasattr(module, "SQL") for name in vars(module) if name.startswith("op") and name[2].isdigit()}
