"""Deterministic ids: the SHA-1 of a node's key parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Key parts of each node label's id (fixed values); a part in quotes is a literal.
ID_PARTS = {
    "company": ("company",),
    "fs_section": ("company", "section_code"),
    "category": ("company", "section_code", "category_path"),
    "year_node": ("company", "section_code", "year"),
    "financial_data": ("company", "year", "item_name", "column_name"),
    "auditor": ("auditor",),
    "audit_info": ("company", "year", "audit_type"),
    "note": ("company", "year", "note_number"),
    "note_category": ("note_category",),
    "fs_category": ("company", "section_code", "category"),
    "search_doc": ("company", "year", "doc_type", "anchor"),
    "subsidiary": ("company", "subsidiary"),
    "affiliate": ("company", "'affiliate'", "affiliate"),
    "joint_venture": ("company", "'joint_venture'", "joint_venture"),
    "special_relation": ("company", "'special_relation'", "special_relation"),
    "concept": ("concept", "concept_category"),
    "risk_term": ("risk_term", "risk_category"),
    "detailed_financial_data": ("company", "section_code", "year", "category_path", "metric", "unit", "source_ref"),
    "detailed_audit_info": ("company", "year", "info_type", "text_hash"),
    "financial_trend": ("company", "item_name", "section_code", "trend_type"),
}


def id_part(part: Column | str) -> Column:
    c = F.col(part) if isinstance(part, str) else part
    return F.lower(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""))


def sha1_id(*parts: Column | str) -> Column:
    """SHA-1 of the trimmed, lower-cased parts, joined by a bar; null where a part is null."""
    joined = id_part(parts[0])
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("|"), id_part(part))
    return F.sha1(joined)


def node_id(label: str, **columns: Column | str) -> Column:
    """The id of a node; ``columns`` renames its key parts where the table calls them otherwise."""
    parts = (F.lit(p.strip("'")) if p.startswith("'") else columns.get(p, p) for p in ID_PARTS[label])
    return sha1_id(*parts)
