"""Named queries with parameters: SQL whose values are bound, never pasted in, and checked before it runs."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Template:
    """``sql`` names tables as ``{table}`` and values as ``:value``; a parameter without a default is required."""

    name: str
    description: str
    sql: str
    tables: tuple[str, ...]
    required: tuple[str, ...] = ()
    defaults: dict[str, Any] = field(default_factory=dict)

    @property
    def parameters(self) -> tuple[str, ...]:
        return (*self.required, *self.defaults)


#: Words by which templates are grouped (fixed values).
GROUPS = {
    "hierarchical": ("계층", "구조", "레벨"), "temporal": ("연도", "트렌드", "변화", "성장"), "relationship": ("종속기업", "관계", "투자", "거래"),
    "analysis": ("분석", "순위", "상관관계"), "notes": ("주석", "문서", "설명"),
}
#: ``facts`` has ``item_name, section_code, year, value``.
_ALL = (
    Template(
        "growth", "연도 사이의 성장 순위",
        """SELECT a.item_name, a.section_code, a.value AS base_value, b.value AS value, CASE WHEN a.value > 0 THEN (b.value - a.value) / a.value * 100 ELSE 0 END AS growth
        FROM {facts} a JOIN {facts} b ON a.item_name = b.item_name AND a.section_code = b.section_code WHERE a.year = :year1 AND b.year = :year2 AND abs(b.value - a.value) > :least
        ORDER BY abs(CASE WHEN a.value > 0 THEN (b.value - a.value) / a.value * 100 ELSE 0 END) DESC, a.item_name, a.section_code LIMIT :top""",
        ("facts",), ("year1", "year2"), {"least": 0, "top": 20},
    ),
    Template(
        "ranking", "연도별 항목 순위 분석",
        "SELECT item_name, sum(value) AS total, count(*) AS n FROM {facts} WHERE year = :year AND section_code = :section GROUP BY item_name ORDER BY total DESC, item_name LIMIT :top",
        ("facts",), ("year", "section"), {"top": 10},
    ),
    Template(
        "history", "항목의 연도별 트렌드",
        """SELECT item_name, section_code, array_join(transform(array_sort(collect_list(struct(year, value))), x -> concat(x.year, '=', x.value)), ',') AS history, count(*) AS n
        FROM {facts} WHERE item_name LIKE :pattern GROUP BY item_name, section_code HAVING count(*) >= :least""",
        ("facts",), ("pattern",), {"least": 2},
    ),
    Template(
        "sections", "두 재무제표의 구조 비교",
        """SELECT a.item_name, a.year, a.value AS one, b.value AS other FROM {facts} a JOIN {facts} b ON a.item_name = b.item_name AND a.year = b.year
        WHERE a.section_code = :one AND b.section_code = :other""",
        ("facts",), ("one", "other"),
    ),
)
TEMPLATES = {t.name: t for t in _ALL}


def of_group(group: str) -> dict[str, Template]:
    """The templates of a group; none for a group that is not known."""
    words = GROUPS.get(group, ())
    return {n: t for n, t in TEMPLATES.items() if any(w in t.description for w in words)}


def run(spark: SparkSession, name: str, tables: dict[str, DataFrame], **values: Any) -> DataFrame:
    """A template's result; what is missing or unknown among tables and values is an error before anything runs."""
    if name not in TEMPLATES:
        raise ValueError(f"there is no template {name!r}")
    t = TEMPLATES[name]
    if missing := [p for p in t.required if values.get(p) is None]:
        raise ValueError(f"missing required parameters: {missing}")
    if unknown := [p for p in values if p not in t.parameters]:
        raise ValueError(f"unknown parameters: {unknown}")
    if absent := [x for x in t.tables if x not in tables]:
        raise ValueError(f"missing tables: {absent}")
    return spark.sql(t.sql, args=t.defaults | values, **{x: tables[x] for x in t.tables})
