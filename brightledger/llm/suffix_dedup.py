"""Repeated byte strings, by prefix-free parsing.

A rolling hash triggers at the locally smallest gram of every window's length of text, so any two equal
strings of ``LENGTH`` bytes trigger at the same place within. The text between the furthest ends that a
trigger's strings can reach is its phrase; phrases overlap by more than a trigger, as prefix-free parsing
asks. The parse says which document has which phrase where. A phrase that a smaller document has too settles all its
strings at once, which is what makes repetitive text cheap. The phrases that are left are the dictionary, dealt by
trigger. Each part sorts its dictionary's suffixes by their bytes (prefix doubling), which with the parse is the order of
the corpus: suffixes of the order with ``LENGTH`` bytes in common are occurrences of one string, and the smallest
document among them keeps it. Since phrases overlap by a whole string, no string goes beyond its phrase, so ranks of the
parse need not break ties.

Defined cases: null texts are empty; texts shorter than a string keep every byte; strings are judged on the
input; rows alike in doc_id and text are one document, and rows that share only the doc_id do not remove
each other's bytes; a null doc_id is larger than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from brightledger.llm.common import read
from brightledger.llm.repeats import Rule, without_repeats
from brightledger.llm.spans import BYTE_TOKENS, local_minima, mixed, stretches

LENGTH = 50
GRAM = 20


def _tokens(data, bounds):
    return BYTE_TOKENS[data], bounds


def _triggers(length: int, gram: int):
    def anchors(hashed, bounds):
        n = len(hashed.sums) - 1
        if n < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(n - gram + 1)
        h = mixed(hashed.of(at, at + gram)) | np.uint64(1)  # zero stands for "no window here"
        pos = local_minima(h, bounds, gram, length)
        return pos, h[pos]

    return anchors


def _finish(text: bytes, covered):
    if covered is None:
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    left = np.frombuffer(text, np.uint8)[~covered].tobytes()
    return len(text), int(covered.sum()), len(stretches(covered)), hashlib.sha256(left).hexdigest()


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, a row for every input row."""
    rule = Rule(length, gram, _tokens, _triggers(length, gram), strings=True)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    kinds = [pa.int64()] * 3 + [pa.string()]
    return without_repeats(docs, rule, schema, ["n_bytes", "n_removed", "n_spans", "kept_sha256"], kinds, _finish, id_col, text_col)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(read(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents
), b AS (
  SELECT doc_id, n, o, substring(h, 2 * o + 1, 2098) AS h FROM (SELECT doc_id, n, h, unnest(range(0, n, 1000)) AS o FROM d)
), s AS (
  SELECT doc_id, o, h, unnest(range(1, least(1000, n - 49 - o) + 1)) AS i FROM b WHERE n - o >= 50
), k AS (
  SELECT doc_id, o + i AS i, md5(substring(h, 2 * i - 1, 100)) AS key FROM s
), m AS (
  SELECT key, min(doc_id) AS first FROM k GROUP BY key
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM k JOIN m USING (key) WHERE doc_id > first
), r AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE p <> before + 1 OR before IS NULL) AS n_spans
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM c) GROUP BY doc_id
), t AS (
  SELECT doc_id, o + i AS p, substring(h, 2 * i - 1, 2) AS byte
  FROM (SELECT doc_id, o, h, unnest(range(1, least(1000, n - o) + 1)) AS i FROM b WHERE doc_id IN (SELECT doc_id FROM r))
), kept AS (
  SELECT t.doc_id, string_agg(t.byte, '' ORDER BY t.p) AS left
  FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.p = c.p WHERE c.p IS NULL GROUP BY t.doc_id
)
SELECT d.doc_id, d.n AS n_bytes, coalesce(r.n_removed, 0) AS n_removed, coalesce(r.n_spans, 0) AS n_spans,
       sha256(CASE WHEN r.doc_id IS NULL THEN unhex(d.h) ELSE unhex(coalesce(kept.left, '')) END) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
