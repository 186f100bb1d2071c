"""Column functions over statement text: normalising, numbers, labels, units, dates, intents.

All are compositions of built-in functions, so they stay in the JVM and inside generated code; only positions of matches,
which no built-in function tells, come from an Arrow UDF.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from brightledger.functions.dictionary import first_of, found_words

# --- fixed values: word lists and patterns of statement text

TERMS = {
    "재무상태표": "BS", "손익계산서": "PL", "포괄손익계산서": "PL", "현금흐름표": "CF", "자본변동표": "EQ", "주석": "NOTE",
    "감사의견": "AUDIT", "매출액": "REV", "매출원가": "COGS", "영업이익": "OPI", "당기순이익": "NI", "자산": "ASSET",
    "부채": "LIAB", "자본": "EQUITY", "현금": "CASH", "투자": "INV",
}
STATEMENTS = {"BS": ("재무상태표",), "PL": ("손익계산서", "포괄손익계산서"), "CF": ("현금흐름표",), "EQ": ("자본변동표",)}
TOP_LEVEL = ("자산", "부채", "자본")
DETAIL = ("후속적으로", "전기이월", "미처분")
ROMAN = "ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
LETTERED = "가나다라마바사아자차카타파하"
INTENTS = (
    ("hierarchical_analysis", ("계층", "레벨", "구조", "상위", "하위", "세부", "구성")),
    ("category_analysis", ("카테고리", "분류", "항목별", "구성항목", "구성 항목", "구성 요소", "세부항목", "세부 항목")),
    ("notes_analysis", ("주석", "각주", "설명", "문서", "내용", "요약")),
    ("year_over_year", ("비교", "대비", "증가율", "감소율", "변화율", "성장률")),
    ("section_summary", ("요약", "개요", "주요항목", "주요 항목", "핵심", "요점")),
    ("complex_analysis", ("모두", "모든", "종합", "분석", "복합", "전체")),
    ("financial_trends", ("추이", "변화", "연도별", "기간", "트렌드", "흐름")),
    ("year_analysis", ("평균", "합계", "최대", "최소", "상위", "집계", "총계")),
    ("subsidiaries", ("종속기업", "자회사", "subsidiary", "관계기업")),
    ("financial_data", ("재무", "매출", "자산", "부채", "이익", "현금", "자본")),
    ("relationships", ("투자", "거래", "채무", "관계", "보증")),
    ("year_analysis", ("년", "연도", *map(str, range(2014, 2025)))),
)
INTENT_LIMITS = {
    "hierarchical_analysis": 100, "category_analysis": 100, "year_over_year": 50, "financial_data": 200,
    "notes_analysis": 50, "subsidiaries": 100, "complex_analysis": 200, "section_summary": 20,
}
WRITES = r"(?i)\b(CREATE|MERGE|SET|DELETE|REMOVE|LOAD\s+CSV|CALL\s|APOC\.|DROP|DETACH|INDEX|CONSTRAINT|PROCEDURE|FUNCTION)\b"
OWNERSHIP_TYPES = {
    "SUBSIDIARY": ("종속기업", "subsidiary"),
    "AFFILIATE": ("관계기업", "affiliate"),
    "JOINT_VENTURE": ("공동기업", "joint_venture", "공동지배"),
}
AUDIT_TYPES = (("내부회계", "내부회계관리제도"), ("검토", "검토의견"), ("독립.*감사|감사.*독립", "독립감사의견"), ("외부감사", "외부감사"))
OPINIONS = ("무한정적정의견", "부적정의견", "한정의견", "의견거절", "적정의견")
DATES = (r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", r"(\d{4})\.\s*(\d{1,2})\.\s*(\d{1,2})", r"(\d{4})-(\d{1,2})-(\d{1,2})")
#: Names stand before those that they contain, so that the longer one is found.
AUDITORS = ("삼정회계법인", "삼일회계법인", "딜로이트안진회계법인", "안진회계법인", "EY한영회계법인", "한영회계법인", "삼정KPMG")
AMOUNT_UNITS = "백만원|억원|조원|천원|만원"
MONEY_UNITS = (("백만원", 1_000_000), ("천원", 1_000), ("억원", 100_000_000), ("원", 1))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def replaced(col: Column, *steps: tuple[str, str]) -> Column:
    for pattern, to in steps:
        col = F.regexp_replace(col, pattern, to)
    return col


def stripped(col: Column | str) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def any_of(col: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | col.contains(w)
    return found


# --- normalising


def normal_text(col: Column | str) -> Column:
    """White space collapsed, currency signs as words, numbers joined to their units, brackets and punctuation tidied."""
    return replaced(
        stripped(col), (r"\s+", " "), ("₩", "원"), (r"\$", "USD"), ("€", "EUR"), (r"(\d+)\s+(백만원|억원|천원|만원|조원|원|%)", "$1$2"),
        (r"\(\s+", "("), (r"\s+\)", ")"), (r"\.{2,}", "..."), (",{2,}", ","), (r"\?{2,}", "?"), ("!{2,}", "!"),
    )


def section_text(col: Column | str) -> Column:
    """Normal text whose empty lines are gone."""
    lines = F.split(replaced(normal_text(col), (r"[ \t]+\n", "\n")), "\n")
    return F.array_join(F.filter(lines, lambda x: F.length(F.trim(x)) > 0), "\n")


def cell_text(col: Column | str) -> Column:
    """Normal text of a cell: no thousands separators, bracketed numbers negative."""
    return replaced(normal_text(col), (r"(\d)\s*,\s*(?=\d)", "$1"), (r"\((\d+(?:\.\d+)?)\)", "-$1"))


def search_text(col: Column | str, most: int = 10_000) -> Column:
    """Letters, digits and basic punctuation of the first ``most`` characters, white space collapsed."""
    cut = F.substring(_c(col), 1, most)
    return F.coalesce(
        stripped(replaced(cut, (r"\s+", " "), (r"(?U)[^\w\s.,;:()\-]", " "), (r"\s+", " "))), F.lit("")
    )


def slug(col: Column) -> Column:
    """A path component for search: lower case, blanks as single underscores, other signs dropped."""
    return replaced(F.lower(stripped(col)), (r"\s+", "_"), (r"[^0-9a-z가-힣_]", ""), ("_+", "_"), ("^_+|_+$", ""))


def path_keys(path: Column | str) -> dict[str, Column]:
    parts = F.filter(F.transform(F.split(F.coalesce(_c(path), F.lit("")), ">"), stripped), lambda x: x != "")
    slugs = F.transform(parts, slug)
    return {
        "path_normalized": F.array_join(slugs, ">"),
        "path_tokens": F.array_join(slugs, " "),
        "path_key": F.array_join(F.transform(slugs, lambda x: F.regexp_replace(x, "[^0-9a-z가-힣]", "")), ">"),
    }


# --- numbers


def financial_value(col: Column | str) -> Column:
    """The number of a printed cell: brackets or a leading dash negative; a dash alone, or no number, null."""
    bare = F.regexp_replace(_c(col), r"[,\s]", "")
    negative = bare.startswith("-") | (bare.startswith("(") & bare.endswith(")"))
    body = F.when(bare.startswith("("), F.regexp_replace(bare, r"^\(|\)$", "")).otherwise(F.regexp_replace(bare, "^-", ""))
    number = F.regexp_replace(body, r"[^\d.\-]", "").try_cast("double")
    return F.when(bare.isin("", "-", "None", "null"), None).when(negative, -F.abs(number)).otherwise(number)


def loose_amount(col: Column | str) -> Column:
    return F.translate(_c(col), ", ", "").try_cast("double")


def is_amount(col: Column | str) -> Column:
    """A number of at least three characters."""
    bare = F.translate(_c(col), ", ", "")
    return F.coalesce(bare.try_cast("double").isNotNull() & (F.length(bare) >= 3), F.lit(False))


def trend_value(col: Column | str) -> Column:
    """Looser reading for trends: an opening bracket is a sign, zero is nothing."""
    v = replaced(_c(col), ("[, ]", ""), (r"\(", "-"), (r"\)", "")).try_cast("double")
    return F.when(v != 0, v)


def percentages(col: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(_c(col), F.lit(r"(\d+(?:\.\d+)?)\s*%"), 1), lambda x: x.cast("double"))


def ownership_percentage(col: Column | str) -> Column:
    """The first percentage, if it lies between 0 and 100."""
    p = F.try_element_at(percentages(col), F.lit(1))
    return F.when(p.between(0, 100), p)


#: Values of a batch that are Python objects at a time.
SLICE = 100


def sliced(f: Callable, of: pa.DataType) -> Callable:
    """``f`` of each value of a batch; whatever its size, only a slice at a time is held as Python objects, the rest as Arrow has it."""

    def taken(values: pa.Array) -> pa.Array:
        parts = [pa.array([f(v.as_py()) for v in values.slice(i, SLICE)], of) for i in range(0, len(values), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], of)

    # A function of its own, which goes to the workers whole, wherever this module is.
    return taken


def by_slices(values: pa.Array, f: Callable, of: pa.DataType) -> pa.Array:
    return sliced(f, of)(values)


def matches(col: Column | str, patterns: Sequence[tuple[str, str]]) -> Column:
    """``array<struct<label, original, position, length>>`` of all matches of labelled patterns, by position; case does not count."""
    compiled = [(label, re.compile(pattern, re.IGNORECASE)) for label, pattern in patterns]

    of = pa.list_(pa.struct([("label", pa.string()), ("original", pa.string()), ("position", pa.int32()), ("length", pa.int32())]))

    def one(text):
        if text is None:
            return None
        hits = [{"label": label, "original": m.group(), "position": m.start(), "length": m.end() - m.start()} for label, p in compiled for m in p.finditer(text)]
        return sorted(hits, key=lambda h: h["position"])

    take = sliced(one, of)

    @F.arrow_udf("array<struct<label:string,original:string,position:int,length:int>>")
    def found(texts: pa.Array) -> pa.Array:
        return take(texts)

    return found(_c(col))


def amount_positions(col: Column | str) -> Column:
    """Where the amounts of a text are, labelled ``negative`` and ``positive``."""
    return matches(col, (("negative", rf"\(\d+(?:,\d{{3}})*\)\s*(?:{AMOUNT_UNITS})"), ("positive", rf"(?<![\d(,])\d+(?:,\d{{3}})*\s*(?:{AMOUNT_UNITS})")))


def amounts(col: Column | str) -> Column:
    """Amounts with their unit: ``array<struct<value, unit, negative>>``, bracketed ones first."""
    unit = AMOUNT_UNITS
    negative = F.regexp_extract_all(_c(col), F.lit(rf"\(\d+(?:,\d{{3}})*\)\s*(?:{unit})"), 0)
    plain = F.regexp_extract_all(_c(col), F.lit(rf"(?<![\d(,])\d+(?:,\d{{3}})*\s*(?:{unit})"), 0)

    def parsed(sign: int):
        def one(x: Column) -> Column:
            v = F.regexp_replace(x, r"[^\d]", "").cast("double") * sign
            return F.struct(v.alias("value"), F.regexp_extract(x, f"({unit})", 1).alias("unit"), F.lit(sign < 0).alias("negative"))

        return one

    return F.concat(F.transform(negative, parsed(-1)), F.transform(plain, parsed(1)))


def currency_text(col: Column | str) -> Column:
    v = _c(col)
    text = F.format_string("%,.0f", v)
    for size, name in ((1e4, "만"), (1e8, "억"), (1e12, "조")):
        text = F.when(F.abs(v) >= size, F.concat(F.format_string("%.1f", v / size), F.lit(name))).otherwise(text)
    return F.when(v.isNull() | (v == 0), "0원").otherwise(F.concat(text, F.lit("원")))


# --- notes


def is_note_column(col: Column | str) -> Column:
    return any_of(F.lower(F.regexp_replace(_c(col), " ", "")), ("주석", "note", "비고"))


def note_reference(col: Column | str) -> Column:
    """The numbers of a strict comma list, else null."""
    t = stripped(col)
    return F.when(t.rlike(r"^\d+(?:,\s*\d+)*$"), F.transform(F.split(t, r",\s*"), lambda x: x.try_cast("int")))


def note_numbers(col: Column | str) -> Column:
    """Note numbers of any reference style, distinct and sorted; all numbers of the text if no style fits."""
    t = F.coalesce(stripped(col), F.lit(""))
    circled = F.filter(F.array(*[F.when(t.contains(c), F.lit(i + 1)) for i, c in enumerate(CIRCLED)]), lambda x: x.isNotNull())
    styles = (r"(?:Note|note|주석|주 석)\s*(\d+)", r"(\d+)\)", r"(\d+)\s*[,，;；]", r"(\d+)(?:\s|$)")
    found = F.concat(*[F.regexp_extract_all(t, F.lit(s), 1) for s in styles])

    def numbers(a: Column) -> Column:
        return F.filter(F.transform(a, lambda x: x.try_cast("int")), lambda x: x.isNotNull())

    known = F.concat(circled, numbers(found))
    every = numbers(F.regexp_extract_all(t, F.lit(r"(\d+)"), 1))
    return F.array_sort(F.array_distinct(F.when(F.size(known) > 0, known).otherwise(every)))


def note_strings(col: Column | str) -> Column:
    """An array of the non-blank strings, null if none is left."""
    kept = F.filter(F.transform(_c(col), stripped), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, kept)


# --- labels and columns


def period(col: Column | str) -> Column:
    """``current`` or ``previous`` for a period's column name, else null."""
    key = replaced(_c(col), (r"\s+", ""), (r"\.\d+$", ""))
    return F.when(key.rlike(r"당기|\(당\)기"), "current").when(key.rlike(r"전기|\(전\)기"), "previous")


def has_numbering(col: Column | str) -> Column:
    return stripped(col).rlike(rf"^([{ROMAN}]|\d|[{LETTERED}]\.)")


def hierarchy_level(col: Column | str) -> Column:
    """Level 1 to 5 of a label by its numbering."""
    name = stripped(col)
    return (
        F.when(name.rlike(r"\d{4}\s*\.\s*\d{1,2}\s*\.\s*\d{1,2}\s*\((당기말|전기말|당기초|전기초)\)"), 1)
        .when(any_of(F.regexp_replace(name, " ", ""), TOP_LEVEL) & ~has_numbering(name), 1)
        .when(name.rlike(f"[{ROMAN}]"), 2)
        .when(name.rlike(r"^\d+\."), 3)
        .when(name.rlike(rf"^[{LETTERED}]\."), 4)
        .when(any_of(name, DETAIL), 5)
        .otherwise(3)
    )


def clean_label(col: Column | str) -> Column:
    """A label without numbering and bullets, brackets tidied, spaced-out syllables joined."""
    bare = replaced(stripped(col), (rf"[{ROMAN}]+\.?\s*", ""), (rf"^[{LETTERED}]\.\s+", ""), (r"\s+", " "))
    dated = bare.rlike(r"^\d{4}\s*\.\s*\d{1,2}\s*\.\s*\d{1,2}")
    bare = F.when(dated, bare).otherwise(replaced(bare, (r"^\d+\.\s+", ""), (r"^\(\d+\)\s*", ""), (r"^\d+\)\s*", "")))
    return replaced(bare, (r"\(\s+", "("), (r"\s+\)", ")"), (r"\s+\(", "("), (r"(?<=(?:^|[\s(])[가-힣])\s+(?=[가-힣](?:[\s()]|$))", ""))


def statement_type(col: Column | str, english: bool = False) -> Column:
    """The first statement whose name the text has."""
    rules = F.when(F.lit(False), "")
    for code, words in STATEMENTS.items():
        rules = rules.when(any_of(_c(col), words), code)
    if english:
        low = F.lower(_c(col))
        for code, word in (("BS", "balance"), ("PL", "income"), ("CF", "cash"), ("EQ", "equity")):
            rules = rules.when(low.contains(word), code)
        rules = rules.otherwise("OTHER")
    return rules


def unit_of(col: Column | str) -> Column:
    """``struct<unit, type, multiplier>`` of one unit's name."""
    t = F.lower(F.regexp_replace(_c(col), " ", ""))

    def unit(label: Column | str, kind: str, factor: int | None) -> Column:
        name = F.lit(label) if isinstance(label, str) else label
        return F.struct(name.alias("unit"), F.lit(kind).alias("type"), F.lit(factor).cast("long").alias("multiplier"))

    rules = F.when(F.lit(False), unit("", "", None))
    for name, factor in MONEY_UNITS:
        rules = rules.when(t.contains(name), unit(name, "money", factor))
    rules = rules.when(any_of(t, ("usd", "us$", "달러")), unit(stripped(col), "money", None))
    rules = rules.when(t.contains("천주"), unit("천주", "shares", 1000)).when(t.contains("주"), unit("주", "shares", 1))
    rules = rules.when(any_of(t, ("%", "percent", "퍼센트", "율")), unit("%", "percent", None))
    return rules.otherwise(unit(stripped(col), "other", None))


def units(col: Column | str) -> Column:
    """All units of a ``(단위: a, b)`` remark, null without one."""
    inner = F.regexp_extract(_c(col), r"\(\s*단위\s*[:：]\s*([^)]+)\)", 1)
    names = F.filter(F.split(inner, "[,，;；·]+"), lambda x: F.length(F.trim(x)) > 0)
    return F.when(inner != "", F.transform(names, unit_of))


# --- companies, audits, questions


def ownership_class(percentage: Column | str, kind: Column | str) -> Column:
    p, k = _c(percentage), _c(kind)
    by_type = F.when(F.lit(False), "")
    for label, words in OWNERSHIP_TYPES.items():
        by_type = by_type.when(k.isin(*words), label)
    low = F.when(k.isin(*OWNERSHIP_TYPES["JOINT_VENTURE"]), "JOINT_VENTURE").otherwise("SPECIAL_RELATION")
    return F.when(p >= 50, "SUBSIDIARY").when(p >= 20, "AFFILIATE").when(p.isNotNull(), low).otherwise(by_type.otherwise("SPECIAL_RELATION"))


def relationship_type(col: Column | str) -> Column:
    t = F.lower(_c(col))
    return (
        F.when(any_of(t, ("종속기업", "subsidiary")), "종속기업")
        .when(t.contains("관계기업") & ~t.contains("특수관계기업") | t.contains("affiliate"), "관계기업")
        .when(any_of(t, ("공동기업", "joint_venture", "공동지배")), "공동기업")
        .when(any_of(t, ("특수관계기업", "special_relation")), "특수관계기업")
        .otherwise("unknown")
    )


#: Buckets of companies by their relationship, before ownership is looked at (fixed values).
INITIAL_BUCKETS = (("subsidiaries", ("종속기업", "subsidiary")), ("affiliates", ("관계기업", "affiliate")), ("joint_ventures", ("공동기업", "joint_venture")))


def initial_bucket(kind: Column | str) -> Column:
    """The bucket that a relationship's name puts a company in; special relations for every other, and for none."""
    rules = F.when(F.lit(False), "")
    for bucket, names in INITIAL_BUCKETS:
        rules = rules.when(_c(kind).isin(*names), bucket)
    return rules.otherwise("special_relations")


def loose_percentage(col: Column | str) -> Column:
    """A percentage by the looser reading: percent signs and blanks left out; null where the rest is no number."""
    return F.regexp_replace(_c(col).cast("string"), "[% ]", "").try_cast("double")


def audit_opinion(col: Column | str) -> Column:
    """The opinion named in the text; where the words only occur apart, the clean one."""
    t = _c(col)
    rules = F.when(F.lit(False), "")
    for opinion in OPINIONS:
        rules = rules.when(t.contains(opinion), opinion)
    return rules.when(t.contains("감사") & t.contains("의견"), "적정의견")


def audit_type(title: Column | str) -> Column:
    rules = F.when(F.lit(False), "")
    for pattern, label in AUDIT_TYPES:
        rules = rules.when(_c(title).rlike(pattern), label)
    return rules.otherwise("감사의견")


def auditor(col: Column | str) -> Column:
    """The first auditor that a text names, whatever its blanks and the case of its letters."""
    bare = F.upper(F.regexp_replace(_c(col), r"\s+", ""))
    rules = F.when(F.lit(False), "")
    for name in AUDITORS:
        rules = rules.when(bare.contains(name.upper()), name)
    return rules


def iso_date(col: Column | str) -> Column:
    """The first date of the text, as ISO text, by the first style that occurs."""
    found = []
    for style in DATES:
        y, m, d = (F.regexp_extract(_c(col), style, i) for i in (1, 2, 3))
        found.append(F.when(y != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))))
    return F.coalesce(*found)


def intent(col: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = INTENTS, default: str = "company_info") -> Column:
    """The first rule one of whose words the question has."""
    t = F.lower(_c(col))
    found = F.when(F.lit(False), "")
    for label, words in rules:
        found = found.when(any_of(t, words), label)
    return found.otherwise(default)


def intents(col: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = INTENTS, default: str = "company_info") -> Column:
    """As ``intent``, but the question is read once for the words of all rules."""
    return first_of(found_words(col, [w for _, words in rules for w in words]), rules, default)


def writes(col: Column | str) -> Column:
    """Whether a query text has a clause that would change data."""
    return F.coalesce(_c(col).rlike(WRITES), F.lit(False))


# --- content


def term_counts(col: Column | str, terms: dict[str, str] = TERMS) -> Column:
    """``array<struct<term, code, n>>`` of the terms that occur."""
    counted = [
        F.struct(F.lit(t).alias("term"), F.lit(c).alias("code"), F.regexp_count(_c(col), F.lit(t)).cast("int").alias("n")) for t, c in terms.items()
    ]
    return F.filter(F.array(*counted), lambda x: x["n"] > 0)


def term_positions(col: Column | str, terms: dict[str, str] = TERMS) -> Column:
    """Where the terms of a text are, labelled with their codes."""
    return matches(col, [(code, re.escape(term)) for term, code in terms.items()])


def richness(text: Column | str, n_terms: Column, n_numbers: Column) -> Column:
    """How much a text has to say: terms and numbers per word, and length; at most 1."""
    t = stripped(text)
    words = F.greatest(F.size(F.filter(F.split(t, r"\s+"), lambda x: x != "")), F.lit(1))
    n = F.length(t)
    longer = sum((F.when(n > k, 0.1).otherwise(0.0) for k in (100, 500, 1000)), F.lit(0.0))
    score = F.least(10 * n_terms / words, F.lit(0.4)) + F.least(10 * n_numbers / words, F.lit(0.3)) + longer
    return F.when(n > 0, F.least(score, F.lit(1.0))).otherwise(0.0)


def text_issues(col: Column | str, terms: Sequence[str] = tuple(TERMS)) -> Column:
    """What a text lacks: ``array<string>``, empty if nothing."""
    t = F.coalesce(_c(col), F.lit(""))
    return F.array_compact(
        F.array(
            F.when(stripped(t) == "", "empty"),
            F.when(~any_of(t, terms), "no_terms"),
            F.when(~t.rlike(r"\d"), "no_digits"),
            F.when(t.rlike(r"(?U)[^\w\s.,;:()\-%]"), "special_characters"),
        )
    )


#: Words of the item buckets that a statement is looked through for (fixed values).
ITEM_BUCKETS = {"revenue": ("매출",), "assets": ("자산",), "liabilities": ("부채",), "equity": ("자본",), "profit": ("손익", "이익")}


def item_buckets(col: Column | str, buckets: dict[str, Sequence[str]] = ITEM_BUCKETS) -> Column:
    """All buckets one of whose words a text has."""
    return F.array_compact(F.array(*[F.when(any_of(_c(col), words), name) for name, words in buckets.items()]))


def without_continued(col: Column | str, markers: Sequence[str]) -> Column:
    """Text without "continued" markers: null where it is nothing else, else with the marker taken out."""
    c = _c(col)
    whole = F.lit(False)
    for m in markers:
        whole = whole | c.rlike(rf"^\s*(?:{m})\s*$")
        c = F.regexp_replace(c, m, "")
    return F.when(~whole, stripped(c))
