"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in batches. A batch's distinct line keys (128 bits of hash), with the number of documents that hold
each and the largest such doc_id, are merge-anti-joined with the runs: keys that no run has become the batch's own run, and
keys that are known already are noted apart. So a key is in one run only. A run is bucketed and sorted by its key, as are the
keys of a batch, so neither is shuffled again when they meet. When a level holds ``fanout`` runs they are merged, bucket
by bucket, into one run of the next level. A line is repeated when its run and its notes together count ``min_docs``
documents; all its lines go but those of the largest doc_id that holds it. A later batch can be added to the same
runs without reading earlier texts again.

Only DataFrame functions run here; texts move once, to meet the positions of their dropped lines, and hot
keys are combined before each shuffle. Defined cases: a null or empty text is one empty line; rows that share a doc_id
are one document, and each still gets its row in the result; a null doc_id is a document smaller
than any other; lines and texts may be of any length; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, shuffle_parts, stored, texts
from brightledger.sources.scratch import shared_folder

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case; other letters stay."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(trimmed) == F.char_length(trimmed)
    return F.when(ascii_only, F.lower(trimmed)).otherwise(F.translate(trimmed, UPPER, LOWER))


def hashed_lines(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """``(doc_id, version, pos, h1, h2)`` of every line whose key is long enough."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.where(F.char_length("line") >= min_chars).select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc_id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


class LineRuns:
    """Levelled runs of ``(h1, h2, n_docs, last_doc)`` with distinct keys, and notes of keys that came again."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = shuffle_parts(spark)
        self.levels: list[list[DataFrame]] = [[]]
        self.notes: list[DataFrame] = []

    def _sorted(self, keys: DataFrame) -> DataFrame:
        """The keys as a table that is bucketed and sorted by key; Spark reads it without a shuffle when it meets another one."""
        name = f"line_run_{uuid.uuid4().hex}"
        files = keys.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{shared_folder(self.spark)}/{name}")
        files.saveAsTable(name)
        return self.spark.table(name)

    def fresh(self, keys: DataFrame) -> DataFrame:
        """Rows whose key no run has yet: merge-anti-joins with the sorted runs, newest level first."""
        for level in self.levels:
            for run in level:
                keys = keys.join(run.select(*KEY), KEY, "left_anti")
        return keys

    def add(self, lines: DataFrame) -> None:
        """Adds one batch of lines; its documents must not be in the runs already."""
        keys = lines.groupBy(*KEY).agg(F.count_distinct(F.struct("doc_id")).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        keys = self._sorted(keys.repartition(self.buckets, *KEY))
        first = not any(self.levels)
        run = keys if first else self._sorted(self.fresh(keys))
        if not first:
            self.notes.append(stored(keys.join(run.select(*KEY), KEY, "left_anti")))
        self._put(run, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = runs[0]
            for other in runs[1:]:
                # Keys are distinct, so an outer join merges the sorted buckets.
                other = other.select(*KEY, F.col("n_docs").alias("n"), F.col("last_doc").alias("last"))
                merged = merged.join(other, KEY, "full_outer").select(*KEY, F.coalesce("n_docs", "n").alias("n_docs"), F.coalesce("last_doc", "last").alias("last_doc"))
            self._put(self._sorted(merged), level + 1)

    def repeated(self, min_docs: int) -> DataFrame:
        """Keys that at least ``min_docs`` documents hold, over all levels, with the largest doc_id."""
        again = None
        for note in self.notes:
            again = note if again is None else again.unionByName(note)
        found = []
        for level in self.levels:
            for run in level:
                if again is not None:
                    more = again.groupBy(*KEY).agg(F.sum("n_docs").alias("n"), F.max("last_doc").alias("last"))
                    run = run.join(more, KEY, "left").select(*KEY, (F.col("n_docs") + F.coalesce("n", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "last").alias("last_doc"))
                found.append(run.where(F.col("n_docs") >= min_docs).select(*KEY, "last_doc"))
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        return stored(every)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
) -> DataFrame:
    """``(doc_id, kept_text, n_lines, n_dropped)``, a row for every input row."""
    rows = texts(docs, id_col, text_col)
    lines = hashed_lines(rows, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    lines = stored(lines, "batch")
    runs = LineRuns(docs.sparkSession)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    found = lines.join(runs.repeated(min_docs), KEY).where("doc_id is null or doc_id < last_doc")
    drops = found.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    left, right = rows.withColumn("version", F.xxhash64("text")), drops.select(F.col("doc_id").alias("id"), F.col("version").alias("v"), "drops")
    joined = left.join(right, left["doc_id"].eqNullSafe(right["id"]) & (left["version"] == right["v"]), "left")
    split = joined.select("doc_id", "text", "drops", F.split("text", "\n").alias("lines"))
    # What lies between two dropped lines is one slice, so the work is linear in the lines.
    starts = F.concat(F.array(F.lit(0)), F.transform("drops", lambda d: d + 1))
    ends = F.concat("drops", F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice("lines", a + 1, b - a)))
    return split.select(
        "doc_id",
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos, string_split(coalesce(text, ''), chr(10)) AS a
  FROM documents
), k AS (
  SELECT doc_id, pos, a[pos] AS line,
         translate(regexp_replace(a[pos], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id < r.last_doc AS gone FROM k LEFT JOIN r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
