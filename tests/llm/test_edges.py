"""Nulls, empties, repeats, clashing columns and empty tables, for every operator."""

import pytest
from pyspark.sql import functions as F

from brightledger.llm import decontaminate, exact_dedup, html_extract, line_dedup, packing, quality, simhash, substring_dedup, suffix_dedup, warc

LONG = " ".join(f"word{i}" for i in range(300))
ROWS = [
    (1, None), (2, ""), (3, " \n\t"), (4, LONG), (4, LONG), (5, LONG), (6, LONG + " tail"), (None, "no id at all, but some text here\nand a line"),
    (7, "ÀÉ 中文 🙂"), (8, "a" * 5000), (8, "another text of the same id"), (9, None),
]
EXTRA = "doc_id long, text string, n int, kept boolean, part int, h string, pos int, fp string, score double, lines string"


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, None, None, 1, "x", 2, None, 0.5, "y") for i, t in rows], EXTRA)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 1, 0), (5, None, 0), (6, 0, 1), (None, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")


def items(spark):
    return spark.createDataFrame([(1, LONG[:200]), (2, None), (None, "some text here"), (3, "")], "item_id long, text string")


RUNS = {
    "op1": lambda s, d: suffix_dedup.repeated_bytes(d),
    "op2": lambda s, d: quality.quality_scores(d, labels(s)),
    "op3": lambda s, d: simhash.near_groups(d),
    "op4": lambda s, d: line_dedup.drop_repeated_lines(d),
    "op6": lambda s, d: packing.packed_documents(d),
    "op7": lambda s, d: substring_dedup.repeated_words(d),
    "op8": lambda s, d: decontaminate.contamination(d, items(s)),
    "op9": lambda s, d: exact_dedup.exact_duplicates(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows(spark, name):
    got = RUNS[name](spark, docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in got if name != "op6") == sorted(str(i) for i, _ in ROWS) or name == "op6"
    assert {r.doc_id for r in got} == {i for i, _ in ROWS}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(spark, name):
    assert RUNS[name](spark, docs(spark, [])).count() == 0


def test_exact_ties(spark):
    got = exact_dedup.exact_duplicates(docs(spark)).orderBy("doc_id").collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.kept for r in by[1]] == [True] and not by[2][0].kept and by[2][0].keep_id == 1 and by[1][0].group_size == 3 - 0
    assert sorted(r.kept for r in by[4]) == [False, True] and by[5][0].keep_id == 4
    assert by[3][0].keep_id == 3  # a blank is not nothing


def test_exact_hash_clashes(spark):
    plain = exact_dedup.exact_duplicates(docs(spark)).orderBy("doc_id", "text_sha256", "kept").collect()
    clashing = exact_dedup.exact_duplicates(docs(spark), hash_bits=2).orderBy("doc_id", "text_sha256", "kept").collect()
    assert plain == clashing


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (2, "u", "<p>" + LONG), (None, "v w\n", "<html>" + LONG), (5, "u", "<html>" + LONG), (6, "u", "<p>short")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, content int")
    got = html_extract.extract_pages(pages).collect()
    assert len(got) == len(rows) and {r.text for r in got if r.page_id == 1} == {""}
    folder = spark.conf.get("spark.checkpoint.dir") + "/warc-test"
    warc.write_warc(pages, folder)
    back = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in warc.read_warc(spark, folder).collect()}
    assert back[None, len("<html>" + LONG)] == ("revisit", 5) and back[5, len("<html>" + LONG)] == ("response", None)
    assert back[1, 0] == ("response", None) and len(back) == len(rows)
    empty = spark.createDataFrame([], pages.schema)
    assert html_extract.extract_pages(empty).count() == 0
    warc.write_warc(empty, folder + "-empty")
    assert warc.read_warc(spark, folder + "-empty").count() == 0


def test_dropped_lines_stay_in_the_last_document(spark):
    line = "A line of more than twenty letters"
    rows = [(1, f"{line}\nown one"), (2, f"x\n  {line.upper()}\t\n"), (3, f"{line}\n{line}"), (4, "short\nshort")]
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs(spark, rows)).collect()}
    assert got[1].kept_text == "own one" and got[2].kept_text == "x\n" and got[3].n_dropped == 0 and got[4].n_dropped == 0


def test_runs_take_later_batches(spark):
    def lines(rows):
        return line_dedup.hashed_lines(spark.createDataFrame(rows, "doc_id long, text string"))

    text = "a line that is long enough to count"
    runs = line_dedup.LineRuns(spark, fanout=2)
    for i in range(5):
        runs.add(lines([(i, text), (i + 100, f"{text} {i}")]))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sum(run.count() for level in runs.levels for run in level) == 6  # every key is in one run
    found = runs.repeated(3).collect()
    assert len(found) == 1 and found[0].last_doc == 4
    later = lines([(200, text), (201, "a line that no earlier batch has had")])
    assert [r.doc_id for r in runs.fresh(later).collect()] == [201]


def test_runs_meet_without_a_shuffle(spark):
    def lines(i):
        return line_dedup.hashed_lines(spark.createDataFrame([(i, f"the line of number {i} that is long enough")], "doc_id long, text string"))

    runs = line_dedup.LineRuns(spark, fanout=9)
    runs.add(lines(1))
    runs.add(lines(2))
    one, two = runs.levels[0]
    plan = one.hint("merge").join(two.select(*line_dedup.KEY), line_dedup.KEY, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_rows_of_one_id_are_one_document(spark):
    line = "a line of more than twenty letters"
    got = line_dedup.drop_repeated_lines(docs(spark, [(1, line), (1, line + "\nx"), (2, line)])).collect()
    assert [r.n_dropped for r in got] == [0, 0, 0]
    got = line_dedup.drop_repeated_lines(docs(spark, [(1, line), (1, line + "\nx"), (2, line), (3, line), (None, line)])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 0)]


def test_record_ids_are_unique(spark):
    """Rows that repeat a page_id have records of their own, and revisits refer to a response that is there."""
    import gzip
    import io

    rows = [(i % 3, "u", "<p>" + LONG) for i in range(9)] + [(7, "u", "<p>x"), (7, "u", "<p>x")]
    folder = spark.conf.get("spark.checkpoint.dir") + "/warc-ids"
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(folder + "-pages")
    warc.write_warc(spark.read.parquet(folder + "-pages"), folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(folder).collect()
    records = [h for f in files for h, _ in warc.parse_warc(gzip.GzipFile(fileobj=io.BytesIO(bytes(f.content))))]
    ids = [h["warc-record-id"] for h in records]
    assert len(set(ids)) == len(rows)
    responses = {h["warc-record-id"] for h in records if h["warc-type"] == "response"}
    assert {h["warc-refers-to"] for h in records if h["warc-type"] == "revisit"} <= responses


def test_small_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "PART_BYTES", 3000)
    rows = [(i, "u", f"<p>{i} " + "long " * 300) for i in range(40)]
    folder = spark.conf.get("spark.checkpoint.dir") + "/warc-small"
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    back = warc.read_warc(spark, folder).collect()
    assert sorted(r.page_id for r in back) == list(range(40)) and {r.record_type for r in back} == {"response"}


def test_largest_id_is_not_null(spark):
    last = 2**63 - 1
    got = suffix_dedup.repeated_bytes(docs(spark, [(1, LONG), (last, LONG + " tail"), (None, "none")])).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in got), key=str) == sorted([(1, 0), (last, len(LONG)), (None, 0)], key=str)
