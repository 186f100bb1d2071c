"""Document fingerprints by prefix polynomial hashes.

A text's prefix arrays hold, for every place, the polynomial hash of all code points before it, modulo the prime
2**31 - 1 and to two bases. A difference of two of their entries, shifted by a power of the base, is the hash of the span
between, wherever it lies: so any two spans are compared at once, and the longest common extension of two places
is found by binary search over its length. A place's hash says nothing of what comes after it, so the arrays of a text
whose end is replaced go on from those of the part that stays.

A fingerprint is the hash of the whole text (16 hex digits, both bases) and a sketch of its spans: of all spans of
``WIDTH`` code points (near the start, where fewer have come, of those), one-permutation minima in ``BINS`` bins, two hex
digits each, 00 for a bin without spans. Fingerprints are compared alone: the share of bins that agree estimates the Jaccard
similarity of the sets of spans, and their likeness is its Dice form, the share of either text's spans that both have.

The query needs each document's successor. Rows are dealt by ranges of the id and sorted within, which moves each text once;
a task streams its part, holding two texts at a time, and hands on the first and the last text of its part, two for each
part, which are paired in a second small step.

Defined cases: a null text counts as empty; the spans of two empty texts are alike, those of an empty and another text
are not; rows that repeat a doc_id are ordered by the XXH64 of their texts, and equal ones follow each other; null doc_ids come
first; the only row of a table follows itself; an empty table gives an empty result; a text takes about 30 bytes of memory per
code point while it is hashed; other columns, whatever their names, do not take part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightledger.llm.common import read, shuffle_parts, slices, stored, texts
from brightledger.llm.spans import mixed

PRIME = np.uint64(2**31 - 1)
P = int(PRIME)
#: Two bases from a fixed seed, and their inverses.
BASES = [int(b) for b in np.random.default_rng(20250114).integers(2**24, P - 1, 2)]
BACK = [pow(b, -1, P) for b in BASES]
#: Code points summed before a reduction: 2**11 products below 2**52 stay below 2**63.
BLOCK = 1 << 11
WIDTH, BINS = 8, 128
ONE, NONE = np.uint64(1), np.uint64(2**64 - 1)


def _powers(bases: list[int]) -> np.ndarray:
    return np.array([[pow(b, i, P) for i in range(BLOCK + 1)] for b in bases], np.uint64)


POWERS, BACK_POWERS = _powers(BASES), _powers(BACK)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def prefixes(codes: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """The prefix arrays, a row for each base: entry ``i`` is the hash of the first ``i`` code points.

    ``before`` are those of a text that ``codes`` goes on from; its entries come first.
    """
    k = 0 if before is None else before.shape[1] - 1
    out = np.zeros((2, k + len(codes) + 1), np.uint32)
    if k:
        out[:, : k + 1] = before
    for at in range(0, len(codes), BLOCK):
        # No code point counts as zero, so that texts of zeros differ by their lengths.
        part = codes[at : at + BLOCK] + ONE
        sums = np.cumsum(part * POWERS[:, : len(part)], axis=1)
        sums %= PRIME
        here = k + at
        if here:
            sums *= np.array([[pow(b, here, P)] for b in BASES], np.uint64)
            sums += out[:, here : here + 1]
            sums %= PRIME
        out[:, here + 1 : here + 1 + len(part)] = sums
    return out


def same_span(one: np.ndarray, i: int, two: np.ndarray, j: int, n: int) -> bool:
    """Whether ``n`` code points from ``i`` of one text are those from ``j`` of another, by their prefix arrays."""
    for row, base in enumerate(BASES):
        a, b = (int(h[row, at + n]) - int(h[row, at]) for h, at in ((one, i), (two, j)))
        if (a * pow(base, max(0, j - i), P) - b * pow(base, max(0, i - j), P)) % P:
            return False
    return True


def common_extension(one: np.ndarray, i: int, two: np.ndarray, j: int) -> int:
    """How many code points from ``i`` of one text are those from ``j`` of another: a binary search over spans, from short ones on."""
    most = min(one.shape[1] - 1 - i, two.shape[1] - 1 - j)
    low, high = 0, min(1, most)
    while low < high and same_span(one, i, two, j, high):
        low, high = high, min(2 * high, most)
    while low < high:
        middle = (low + high) // 2 if high - low > 1 else high
        if same_span(one, i, two, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def span_hashes(prefix: np.ndarray, start: int, end: int, width: int = WIDTH) -> np.ndarray:
    """Hashes, to the first base, of the spans of ``width`` code points (or as many as there are) that end behind ``start`` and up to ``end``."""
    h = prefix[0]
    found = [h[start + 1 : min(width, end) + 1].astype(np.uint64)]
    for at in range(max(start + 1, width + 1), end + 1, BLOCK):
        stop = min(at + BLOCK, end + 1)
        span = (h[at:stop] + PRIME - h[at - width : stop - width]) * BACK_POWERS[0, : stop - at]
        span %= PRIME
        span *= np.uint64(pow(BACK[0], at - width, P))
        span %= PRIME
        found.append(span)
    return np.concatenate(found)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest mixed hash of each bin, which is their first bits."""
    out = np.full(BINS, NONE)
    spread = mixed(hashes)
    np.minimum.at(out, (spread // np.uint64(2**64 // BINS)).astype(np.intp), spread)
    return out


def packed(prefix: np.ndarray, least: np.ndarray) -> bytes:
    """A fingerprint of a text's prefix arrays and the minima of its spans."""
    sketch = np.where(least == NONE, np.uint64(0), least % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return prefix[:, -1].astype(">u4").tobytes() + sketch.tobytes()


def fingerprint(text: str) -> bytes:
    prefix = prefixes(code_points(text))
    return packed(prefix, minima(span_hashes(prefix, 0, prefix.shape[1] - 1)))


def likeness(one: bytes, two: bytes) -> float:
    """The share of spans that two texts have in common, estimated from their fingerprints alone; 1 where those are equal."""
    if one == two:
        return 1.0
    a, b = (np.frombuffer(x, np.uint8, offset=8) for x in (one, two))
    union = int(((a > 0) | (b > 0)).sum())
    agree = int(((a == b) & (a > 0)).sum())
    jaccard = agree / union if union else 1.0
    return 2 * jaccard / (1 + jaccard)


def hex_fingerprint(column: str) -> Column:
    return F.lower(F.hex(column))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``, a row for every row, where the texts lie."""

    def run(batches):
        for batch in slices(batches):
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.binary())], ["doc_id", "fingerprint"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint binary").withColumn("fingerprint", hex_fingerprint("fingerprint"))


class _Read:
    """A text with its code points, prefix arrays and fingerprint."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.codes = code_points(text)
        self.n = len(self.codes)
        self.prefix = prefixes(self.codes)
        # Spans that end in the part that an edit keeps are those of the edited text, too.
        self.kept = self.n - self.n // 4
        self.head = minima(span_hashes(self.prefix, 0, self.kept))
        self.print = packed(self.prefix, np.minimum(self.head, minima(span_hashes(self.prefix, self.kept, self.n))))

    def edited(self, then: _Read) -> tuple:
        """The row of this document, whose last quarter gives way to the beginning of ``then``."""
        new = then.text[: self.n - self.kept]
        prefix = prefixes(then.codes[: len(new)], self.prefix[:, : self.kept + 1])
        tail = minima(span_hashes(prefix, self.kept, prefix.shape[1] - 1))
        other = packed(prefix, np.minimum(self.head, tail))
        sha = hashlib.sha256(self.text[: self.kept].encode())
        sha.update(new.encode())
        return (
            self.doc_id, self.n, sha.digest(), self.print, other, likeness(self.print, other), likeness(self.print, then.print),
            self.kept + common_extension(self.prefix, self.kept, prefix, self.kept), common_extension(self.prefix, 0, then.prefix, 0),
        )


ROW = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, common_edited long, common_next long"
#: Rows of a part, and its ends: the first text, and the last with its id.
PART = f"{ROW}, part int, end string, text string"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def edited_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each document against its edited text and the next document, in ascending order of ids; after the last comes the first.

    ``common_edited`` and ``common_next`` are the code points that the document's beginning has in common with theirs.
    """
    spark = docs.sparkSession
    blank = (None,) * (PART.count(",") - 2)

    def run(batches):
        last, part = None, None
        for batch in slices(batches):
            rows = []
            for part, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                now = _Read(doc_id, text)
                if last is None:
                    rows.append((*blank, part, "first", text))
                else:
                    rows.append((*last.edited(now), part, None, None))
                last = now
            yield _batch(rows, PART)
        if last is not None:
            yield _batch([(last.doc_id, *blank[1:], part, "last", last.text)], PART)

    def run_ends(batches):
        for batch in slices(batches, 20):
            yield _batch([_Read(i, text).edited(_Read(None, then)) for i, text, then in zip(*(c.to_pylist() for c in batch.columns))], ROW)

    rows = texts(docs, id_col, text_col)
    rows = rows.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    keys = ["doc_id", "h", "row"]
    # The number of parts is given, so that they stay as they are dealt.
    placed = rows.repartitionByRange(parts or shuffle_parts(spark), *keys).sortWithinPartitions(*keys)
    made = stored(placed.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, PART))
    first = made.where("end = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("then"))
    last = made.where("end = 'last'")
    # Ids of parts alone, one row for each.
    ids = last.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy())))
    ends = last.select("part", "doc_id", "text").join(ids, "part").join(first, "next_part").select("doc_id", "text", "then").mapInArrow(run_ends, ROW)
    columns = [c.split()[0] for c in ROW.split(", ")]
    found = made.where("end is null").select(*columns).unionByName(ends)
    return found.withColumns({c: hex_fingerprint(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_documents(read(spark, sf_dir, "documents"))
