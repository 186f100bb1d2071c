"""Dictionaries by one automaton, against a scan for each word."""

import random

from brightledger.functions import dictionary as D
from brightledger.functions import text as T
from brightledger.functions.note_words import NOTE_CATEGORIES, NOTE_SUBCATEGORIES, STATEMENT_WORDS
from brightledger.operators import notes
from brightledger.operators.statement_tables import statements_of_tables

WORDS = ["ab", "b", "abc", "bca", "AB", "자본", "자본금", "", "ab"]


def texts(n=200):
    r = random.Random(2)
    return ["".join(r.choice("abcAB자본금 ") for _ in range(r.randrange(30))) for _ in range(n)] + ["", None]


def test_found_words_and_positions(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "t string")
    distinct = [w for w in dict.fromkeys(WORDS) if w]
    for r in df.select("t", D.found_words("t", WORDS).alias("low"), D.found_words("t", WORDS, lower=False).alias("exact"), D.word_positions("t", WORDS).alias("at")).collect():
        if r.t is None:
            assert r.low is r.exact is r.at is None
            continue
        assert r.exact == [w for w in distinct if w in r.t] and r.low == [w for w in distinct if w.lower() in r.t.lower()]
        want = sorted((i, len(w), distinct.index(w)) for w in distinct for i in range(len(r.t)) if r.t.startswith(w, i))
        assert [(p.position, p.n_chars, p.word) for p in r.at] == [(i, n, distinct[k]) for i, n, k in want]
    assert df.limit(1).select(D.found_words("t", []).alias("f")).first().f == []


def brute(title, content):
    text = " ".join(x for x in (title, content) if x is not None).lower()
    hits = {c: sum(w.lower() in text for w in ws) for c, ws in NOTE_CATEGORIES.items()}
    best = max(hits, key=hits.get)
    parts = {p: sum(w.lower() in text for w in ws) for p, ws in NOTE_SUBCATEGORIES.get(best, {}).items()}
    return best, hits[best] / len(NOTE_CATEGORIES[best]), max(parts, key=parts.get) if any(parts.values()) else "기타"


def test_classified(spark):
    r = random.Random(7)
    pool = [w for ws in NOTE_CATEGORIES.values() for w in ws] + [w for p in NOTE_SUBCATEGORIES.values() for ws in p.values() for w in ws] + ["nothing", "K-ifrs"]
    rows = [(i, r.choice([None, "주석 1", "회계"]), " ".join(r.choice(pool) for _ in range(r.randrange(6)))) for i in range(150)] + [(900, None, None), (901, None, "x")]
    got = notes.classified(spark.createDataFrame(rows, "i int, title string, body string"), "title", "body").collect()
    by = {i: (t, b) for i, t, b in rows}
    assert len(got) == len(rows)
    for row in got:
        assert (row.category, row.confidence, row.subcategory) == brute(*by[row.i])
        assert len(row.keywords) == round(row.confidence * len(NOTE_CATEGORIES[row.category]))
    assert got[0].asDict().keys() == {"i", "title", "body", "category", "confidence", "keywords", "subcategory"}


def test_intents_are_those_of_single_scans(spark):
    pool = [w for _, ws in T.INTENTS for w in ws]
    r = random.Random(1)
    df = spark.createDataFrame([(" ".join(r.choice(pool).upper() for _ in range(r.randrange(3))),) for _ in range(200)] + [(None,)], "q string")
    assert all(x.a == x.b for x in df.select(T.intent("q").alias("a"), T.intents("q").alias("b")).collect())


def test_statements_of_tables(spark):
    rows = [(1, 0, 0, "x", "현금"), (1, 1, 0, "x", "흐름"), (2, 0, 0, "당기", "12"), (2, 0, 1, "자산", None), (3, 0, 0, "변동표", "1"), (4, 0, 0, "x", "9"), (5, 0, 0, "x", "PROFIT"), (6, 0, 0, "x", "기타포괄손익")]
    cells = spark.createDataFrame(rows, "table_id int, row_index int, col_index int, column_name string, text string")
    got = {r.table_id: (r.section_code, r.score) for r in statements_of_tables(cells).collect()}
    # A word that stands twice counts twice.
    assert STATEMENT_WORDS["CI"].count("기타포괄손익") == 2
    assert got == {1: ("CF", 2), 2: ("BS", 0), 3: ("EQ", 0), 4: ("", 0), 5: ("PL", 1), 6: ("CI", 3)}
