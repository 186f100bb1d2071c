"""Repeated word windows, by difference-cover anchors.

Only positions whose number modulo ``PERIOD`` lies in a difference cover are hashed. For any two places of a
match there is a shift below the period that brings both onto cover positions, so two equal windows of
``WINDOW`` words share an aligned anchor of ``WINDOW - PERIOD + 1`` words; the match is extended from there
to the windows around the anchor. Words are told apart by 64-bit hashes (long ones by XXH64), windows by 128-bit ones.

Defined cases: null texts have no words; texts of fewer words than a window keep them all; windows are
judged on the input; rows alike in doc_id and text are one document, and rows that share only the doc_id do
not remove each other's words; a null doc_id is larger than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from brightledger.llm.common import read
from brightledger.llm.repeats import Rule, without_repeats
from brightledger.llm.spans import mixed, word_tokens

WINDOW = 50
#: A perfect difference set: every residue but 0 is a difference of exactly one pair (fixed values).
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)


def _tokens(data, bounds):
    return word_tokens(data, bounds)[:2]


def _cover_anchors(gram: int, period: int, cover: tuple[int, ...]):
    chosen = np.zeros(period, bool)
    chosen[list(cover)] = True

    def anchors(hashed, bounds):
        n = len(hashed.sums) - 1
        own = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
        left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
        pos = np.nonzero(chosen[own % period] & (left >= gram))[0]
        return pos, mixed(hashed.of(pos, pos + gram))

    return anchors


def _finish(text: bytes, covered):
    words = text.split()
    kept = words if covered is None else [w for w, gone in zip(words, covered.tolist()) if not gone]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def repeated_words(
    docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, a row for every input row."""
    gram = window - period + 1
    rule = Rule(window, gram, _tokens, _cover_anchors(gram, period, cover))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    kinds = [pa.int64()] * 2 + [pa.string()]
    return without_repeats(docs, rule, schema, ["n_words", "n_removed", "kept_sha256"], kinds, _finish, id_col, text_col)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(read(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50
), k AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS key FROM s
), m AS (
  SELECT key, min(doc_id) AS first FROM k GROUP BY key
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM k JOIN m USING (key) WHERE doc_id > first
), t AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT t.doc_id, count(c.p) AS n_removed, string_agg(t.word, ' ' ORDER BY t.p) FILTER (WHERE c.p IS NULL) AS left
  FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.p = c.p GROUP BY t.doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.left, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
