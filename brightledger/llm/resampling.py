"""Target-distribution importance resampling.

How likely a text is under the target's n-grams rather than the corpus's decides its chance to be drawn. A 256-byte
table lower-cases UTF-8 and blanks what separates words, ``bytes.split`` yields the words, and chained CRC-32 seeds
extend each run by one word: the checksum of ``a b`` continues that of ``a``, so no n-gram is ever put together. The
checksum's remainder is the feature's bucket.

1. Each task counts the buckets of its texts with a ``Counter`` and returns a row for each bucket at the end, so what is
   shuffled is bounded by tasks times buckets, whatever the texts. Corpus and target become one table of ``buckets`` gains,
   which is the bound of what the driver holds and tasks receive.
2. A second pass takes each text's mean gain. Nothing of a text but five numbers is ever moved.
3. The draw orders ``(score, id)`` over all tasks by range, writes that order once, and adds each part's offset to the
   places in it: no task and no driver sees all rows.

Defined cases: null and empty texts and texts without words have no features and weight zero; texts of fewer words than
``least_words`` are scored but never drawn, and do not count among those drawn from; a row without an id has a weight, no score
and no rank, and does not count either; rows that repeat an id are documents of their own, ties between them going to the fewer
features; an empty target or corpus counts zero everywhere; an empty table gives an empty result; texts of any length
are taken in pieces, so a text costs a few bytes of memory per byte; other columns, whatever their names, do not take part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import numbered, read, slices, texts

#: Letters and digits, A-Z as a-z, and all bytes beyond ASCII; every other byte is a blank.
WORD_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Bytes of a text that are split at once.
PIECE = 1 << 20
SIZE, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7


def feature_sums(text: str, size: int) -> Iterator[tuple[int, list[int]]]:
    """``(k, checksums)`` of a text's runs of ``k`` words, a piece of the text at a time; ``k`` goes from 1 to ``size``."""
    data = text.encode().translate(WORD_BYTES)
    at, before = 0, []
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = end if end >= 0 else len(data)
        words = before + data[at:end].split()
        # Runs that end among the words of this piece are new; the last words of the one before begin some of them.
        sums = list(map(crc32, words))
        yield 1, sums[len(before) :]
        for k in range(2, size + 1):
            sums = list(map(crc32, words[k - 1 :], map(crc32, repeat(b" "), sums)))
            yield k, sums[max(0, len(before) - k + 1) :]
        before = words[max(0, len(words) - size + 1) :]
        at = end


def bucket_counts(docs: DataFrame, text_col: str = "text", size: int = SIZE, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how often the features of all texts fall into each bucket that has any."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for _, sums in feature_sums(text.as_py() or "", size):
                    counts.update((np.array(sums, np.int64) % buckets).tolist())
        yield pa.record_batch([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["bucket", "n"])

    return docs.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: dict[int, int], corpus: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's thousandfold log of how much likelier it is in the target, each bucket counted once more in both."""
    of_target, of_corpus = float(sum(target.values()) + buckets), float(sum(corpus.values()) + buckets)
    ratio = ((target.get(b, 0) + 1.0) * of_corpus / ((corpus.get(b, 0) + 1.0) * of_target) for b in range(buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, size: int = SIZE) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of ``(doc_id, text)``: the floored mean gain of a text's features."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for text in batch.column(1):
                n_words = n = total = 0
                for k, sums in feature_sums(text.as_py() or "", size):
                    n_words += len(sums) if k == 1 else 0
                    n += len(sums)
                    total += int(gain[np.array(sums, np.int64) % len(gain)].sum())
                out.append((n_words, n, total // n if n else 0))
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.record_batch([batch.column(0), *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int = SEED) -> Column:
    """A thousandfold Gumbel draw for each id, from the first 32 bits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
    size: int = SIZE, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``, a row for every document; those drawn, without replacement, have a rank."""
    rows = texts(docs, id_col, text_col)
    counted = [{r.bucket: r.n for r in bucket_counts(df, c, size, buckets).collect()} for df, c in ((target, target_text), (rows, "text"))]
    found = weighed(rows, gains(*counted, buckets), size)
    found = found.withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    placed = numbered(found, F.desc("score"), F.asc("doc_id"), F.asc("n_features"), only=F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words))
    drawn = F.col("place") <= F.floor(F.col("n_placed") * percent / 100)
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL = r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS step FROM bits WHERE k = 8
), words AS (
  SELECT 'corpus' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'target', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS (
  SELECT side, doc_id, unnest(w) AS f FROM words
  UNION ALL SELECT side, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
), counted AS (
  SELECT side, doc_id, f, count(*) AS n FROM features GROUP BY ALL
), distinct_features AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)
), hashed AS (
  SELECT f, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: (position(h[2 * i + 1] IN '0123456789ABCDEF') - 1) * 16 + position(h[2 * i + 2] IN '0123456789ABCDEF') - 1)),
    lambda c, b: xor(c // 256, step[(xor(c % 256, b) + 1)])), 4294967295) % 10000 AS bucket
  FROM distinct_features, crc_table
), sums AS (
  SELECT bucket, CAST(sum(n) FILTER (WHERE side = 'corpus') AS BIGINT) AS s, CAST(sum(n) FILTER (WHERE side = 'target') AS BIGINT) AS t
  FROM counted JOIN hashed USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (coalesce(sum(t) OVER (), 0) + 10000)))) AS BIGINT) AS gain FROM sums
), weights AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
  FROM counted JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'corpus' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(CAST(floor(total / n_features) AS BIGINT), 0) AS weight, coalesce(n_features, 0) >= 39 AS long_enough,
         CAST(('0x' || substring(sha256('7:' || CAST(d.doc_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h
  FROM documents d LEFT JOIN weights w USING (doc_id)
), drawn AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score, long_enough FROM scored
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY long_enough ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY long_enough) AS of FROM drawn
)
SELECT doc_id, n_features, weight, score, CASE WHEN long_enough AND place <= 25 * of // 100 THEN place END AS rank FROM placed
"""
