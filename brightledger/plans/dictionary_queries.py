"""Dictionaries at work: note categories, intents and statement codes by their whole word lists, on texts made of lines and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightledger.functions import dictionary as D
from brightledger.functions import text as T
from brightledger.functions.note_words import NO_SUBCATEGORY, NOTE_CATEGORIES, NOTE_SUBCATEGORIES, STATEMENT_COLUMNS, STATEMENT_WORDS
from brightledger.operators import notes as N
from brightledger.operators.statement_tables import statements_of_tables
from brightledger.plans.registry import query
from brightledger.sources.tables import table

NOTE_POOL = list(dict.fromkeys([w for ws in NOTE_CATEGORIES.values() for w in ws] + [w for parts in NOTE_SUBCATEGORIES.values() for ws in parts.values() for w in ws]))
INTENT_POOL = [*dict.fromkeys(w for _, ws in T.INTENTS for w in ws), "안녕", "회사", "무엇"]
STATEMENT_POOL = list(dict.fromkeys(w for ws in STATEMENT_WORDS.values() for w in ws))
COLUMN_POOL = ["당기", "기말", "부채", "자본", "영업활동", "변동표", "기타포괄손익", "매출", "비용", "과목", "주석"]


def _sql(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _hits(words, text: str) -> str:
    return f"len(list_filter({_sql(w.lower() for w in words)}, lambda w: contains({text}, w)))"


def _best(groups: dict, text: str) -> str:
    """A list of scores, the best one first: hits, then the order of the groups."""
    scores = ", ".join(f"{{'hits': {_hits(ws, text)}, 'turn': -{i}, 'name': '{name}', 'parts': {len(ws)}}}" for i, (name, ws) in enumerate(groups.items()))
    return f"list_reverse_sort([{scores}])[1]"


def _picked(pool, index):
    """The word of a pool at a place."""
    return F.element_at(F.array(*map(F.lit, pool)), index.cast("int") + 1)


def made_notes(spark, d):
    """``(note, title, content)``: a note for each order, with a word for each line, every other one in capitals."""
    word = _picked(NOTE_POOL, F.col("l_partkey") % len(NOTE_POOL))
    word = F.when(F.col("l_linenumber") % 2 == 0, F.upper(word)).otherwise(word)
    said = F.struct("l_linenumber", "l_partkey", "l_suppkey", word.alias("word"))
    lines = table(spark, d, "lineitem").where("l_linenumber < 6").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(said)).alias("said"))
    content = F.array_join(F.transform("said", lambda s: F.concat(s["word"], (s["l_suppkey"] % 10).cast("string"))), " ")
    return table(spark, d, "orders").join(lines, "o_orderkey", "left").select(F.col("o_orderkey").alias("note"), F.when(F.col("o_orderkey") % 6 == 0, "주석 Device eXperience").alias("title"), content.alias("content"))


NOTES_SQL = f"""words AS (SELECT {_sql(NOTE_POOL)} AS pool), said AS (
  SELECT l_orderkey AS note, string_agg(CASE WHEN l_linenumber % 2 = 0 THEN upper(pool[l_partkey % {len(NOTE_POOL)} + 1]) ELSE pool[l_partkey % {len(NOTE_POOL)} + 1] END || (l_suppkey % 10), ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS content
  FROM lineitem, words WHERE l_linenumber < 6 GROUP BY 1), made AS (
  SELECT o_orderkey AS note, lower(coalesce(CASE WHEN o_orderkey % 6 = 0 THEN '주석 Device eXperience' END, '') || ' ' || coalesce(content, '')) AS t FROM orders LEFT JOIN said ON note = o_orderkey)"""
PARTS_SQL = " ".join(f"WHEN '{c}' THEN CASE WHEN {_best(p, 't')}.hits > 0 THEN {_best(p, 't')}.name ELSE '{NO_SUBCATEGORY}' END" for c, p in NOTE_SUBCATEGORIES.items())


@query(
    "a8_note_dictionary",
    f"""WITH {NOTES_SQL}, scored AS (SELECT note, t, {_best(NOTE_CATEGORIES, 't')} AS best FROM made)
SELECT note, best.name AS category, CASE best.name {PARTS_SQL} ELSE '{NO_SUBCATEGORY}' END AS subcategory, round(best.hits / best.parts::DOUBLE, 6) AS confidence, best.hits AS n_keywords FROM scored""",
)
def note_dictionary(spark, d):
    """Notes by all categories and subcategories of the dictionary."""
    c = N.classified(made_notes(spark, d), "title", "content")
    return c.select("note", "category", "subcategory", F.round("confidence", 6).alias("confidence"), F.size("keywords").cast("long").alias("n_keywords"))


def made_questions(spark, d):
    """``(question, text)``: an order's key and two words of the intents or of none."""
    n = len(INTENT_POOL)
    text = F.concat_ws(" ", _picked(INTENT_POOL, F.col("o_orderkey") % n), _picked(INTENT_POOL, F.col("o_custkey") % n), F.lit("?"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("question"), text.alias("text"))


@query(
    "f32_all_intents",
    f"""WITH words AS (SELECT {_sql(INTENT_POOL)} AS pool), q AS (SELECT o_orderkey AS question, lower(pool[o_orderkey % {len(INTENT_POOL)} + 1] || ' ' || pool[o_custkey % {len(INTENT_POOL)} + 1] || ' ?') AS t FROM orders, words)
SELECT question, CASE {' '.join(f"WHEN {_hits(ws, 't')} > 0 THEN '{name}'" for name, ws in T.INTENTS)} ELSE 'company_info' END AS intent FROM q""",
)
def all_intents(spark, d):
    """Questions by the first of all rules one of whose words they have."""
    return made_questions(spark, d).select("question", T.intents("text").alias("intent"))


def made_statement_cells(spark, d):
    """Cells of a table per order: words of statements, in a quarter of the tables figures alone, under columns named by the order."""
    l = table(spark, d, "lineitem")
    word = F.when(F.col("l_orderkey") % 4 == 0, F.col("l_partkey").cast("string")).otherwise(_picked(STATEMENT_POOL, F.col("l_partkey") % len(STATEMENT_POOL)))
    word = F.when(F.col("l_linenumber") % 3 == 0, F.upper(word)).otherwise(word)
    names = [_picked(COLUMN_POOL, F.col(c) % len(COLUMN_POOL)) for c in ("l_orderkey", "l_custkey")]
    row = l.join(table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("l_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    made = F.array(*[F.struct(F.lit(i).alias("col_index"), names[i].alias("column_name"), F.when(F.lit(i) == 0, word).alias("text")) for i in (0, 1)])
    return row.select(F.col("l_orderkey").alias("table_id"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("row_index"), F.explode(made).alias("c")).select("table_id", "row_index", "c.*")


def _column_case(text: str) -> str:
    cases = " ".join(f"WHEN {' AND '.join(f'{_hits(ws, text)} > 0' for ws in groups)} THEN '{code}'" for code, groups in STATEMENT_COLUMNS)
    return f"CASE {cases} ELSE '' END"




@query(
    "f36_statement_codes",
    f"""WITH words AS (SELECT {_sql(STATEMENT_POOL)} AS pool, {_sql(COLUMN_POOL)} AS columns), c AS (
  SELECT l_orderkey AS table_id, l_linenumber * 1000000 + l_partkey AS row_index, CASE WHEN l_orderkey % 4 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE pool[l_partkey % {len(STATEMENT_POOL)} + 1] END AS word, l_linenumber,
    columns[l_orderkey % {len(COLUMN_POOL)} + 1] AS one, columns[o_custkey % {len(COLUMN_POOL)} + 1] AS two FROM lineitem JOIN orders ON l_orderkey = o_orderkey, words),
g AS (SELECT table_id, lower(string_agg(word, ' ' ORDER BY row_index, CASE WHEN l_linenumber % 3 = 0 THEN upper(word) ELSE word END)) AS t, any_value(CASE WHEN one <= two THEN one || ' ' || two ELSE two || ' ' || one END) AS names FROM c GROUP BY 1),
s AS (SELECT table_id, names, {_best(STATEMENT_WORDS, 't')} AS best FROM g)
SELECT table_id, CASE WHEN best.hits > 0 THEN best.name ELSE {_column_case('names')} END AS section_code, best.hits AS score FROM s""",
)
def statement_codes(spark, d):
    """Tables by the statement most of whose words they have, else by the names of their columns."""
    return statements_of_tables(made_statement_cells(spark, d)).withColumn("score", F.col("score").cast("long"))


@query(
    "f8_dictionary_positions",
    f"""WITH {NOTES_SQL}, hits AS (SELECT note, word, unnest(list_filter(range(1, length(t) + 1), lambda i: substring(t, i, length(word)) = word)) AS place FROM made, (SELECT unnest({_sql(w for w in ('자산', '자본', '자본금', '현금', '현금흐름', '매출', '매출원가'))}) AS word))
SELECT note, word, CAST(place - 1 AS INTEGER) AS position, CAST(length(word) AS INTEGER) AS n_chars FROM hits""",
)
def dictionary_positions(spark, d):
    """Every place of some words in the notes, overlapping ones too."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))))
    found = made_notes(spark, d).select("note", F.explode(D.word_positions(text, ("자산", "자본", "자본금", "현금", "현금흐름", "매출", "매출원가"))).alias("p"))
    return found.select("note", "p.word", "p.position", "p.n_chars")
