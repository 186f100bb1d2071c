"""The corpus pipeline: quality, exact dedup, near-dedup, decontamination, packing.

Every stage is a function of ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm import decontaminate, exact_dedup, near_stage, packing, quality
from brightledger.llm.common import by_id, dropped, read, stored, texts


def fresh_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts are scored as texts without words; rows without a doc_id are scored too; an empty table stays so.
    """
    model = quality.train(texts(docs), read(spark, sf_dir, "labels"))
    score = fresh_name(docs, "score")
    return quality.scored(docs, model, docs.columns, "text", score).where(F.col(score) >= 0.5).drop(score)


def exact_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts, the row with the smallest doc_id; one without a doc_id only where no row has one.

    Null and empty texts equal each other; of rows that repeat a doc_id one of each text stays; an empty table stays so.
    """
    written: list[str] = []
    copies = exact_dedup.exact_duplicates(docs.where("doc_id is not null"), within=written)
    copies = stored(copies.where("not kept").select("doc_id", "keep_id"))
    dropped(spark, written)
    gone = stored(copies.where("doc_id <> keep_id").select("doc_id").distinct())
    left = by_id(docs.where("doc_id is not null"), gone, "left_anti").select(*docs.columns)
    twice = copies.where("doc_id = keep_id").select("doc_id").distinct()
    if not twice.isEmpty():
        # Rows that repeat with their own doc_id: one of each text stays.
        twice = stored(twice)
        normal = fresh_name(docs, "normal")
        once = by_id(left, twice, "left_semi").withColumn(normal, exact_dedup.normalised("text"))
        left = by_id(left, twice, "left_anti").select(*docs.columns).unionByName(once.dropDuplicates(["doc_id", normal]).select(*docs.columns))
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return left
    sha = fresh_name(docs, "sha")
    key = F.sha2(exact_dedup.normalised("text"), 256)
    once = nameless.withColumn(sha, key).dropDuplicates([sha])
    return left.unionByName(once.join(left.select(key.alias(sha)), sha, "left_anti").select(*docs.columns))


def near_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the document with the smallest doc_id of each group; one without a doc_id only where none has one.

    Null and empty texts and texts without words stay; rows that repeat a doc_id are judged one by one; an empty table stays so.
    """
    written: list[str] = []
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty():
        groups = near_stage.near_copies(docs, within=written)
        gone = stored(groups.where("doc_id <> component").select("doc_id"))
        dropped(spark, written)
        return by_id(docs, gone, "left_anti").select(*docs.columns)
    # Rows that have no id of their own can be told apart by a number only.
    row = fresh_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = stored(near_stage.near_copies(rows.select(F.col(row).alias("doc_id"), "text")))
    members = groups.select(F.col("doc_id").alias(row), "component").join(rows.select(row, "doc_id"), row)
    first = members.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", row)).alias("first"))
    gone = members.select(row).join(first.select(F.col(f"first.{row}").alias(row)), row, "left_anti")
    return rows.join(stored(gone), row, "left_anti").select(*docs.columns)


def clean_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; null and empty texts have none."""
    return decontaminate.uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, with its sequence and offset; an empty document is its end token alone."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_filter),
    ("near_dedup", near_filter),
    ("decontaminate", clean_filter),
    ("pack", best_fit),
]

#: The classifier and the tokeniser have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = read(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        written: list[str] = []
        docs = stored(stage(spark, docs, sf_dir), within=written)
        dropped(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
