"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' normalised words build one automaton per block of at most ``BLOCK_WORDS`` words. Blocks are passes of the
same map, one after the other, with the hits so far stored between them: one automaton at a time is built, sent to the
executors and dropped, so memory is bounded whatever the benchmark's size, and time grows with the number of blocks. Documents stream through it word by word: at each word the automaton gives the longest match that ends
there, and where it covers a whole window of an item, the window's words are hit. Stretches of words that
no item has cannot match and are stepped over. Nothing is shuffled. ``without_spans`` removes what is hit: spans of a
length or more lose their words, and documents that are hit beyond a share go.

Defined cases: null texts have no words, and neither hit nor are hit; an item shorter than a window is one
window; repeated items and rows count as they stand; items without an id count as an empty id; an empty
benchmark hits nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, slices, stored, texts

WINDOW = 10
BLOCK_WORDS = 200_000
#: Lower-cases A-Z, keeps a-z, 0-9 and bytes beyond ASCII, and makes the rest blanks.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class ItemAutomaton:
    """Generalised suffix automaton over words, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: set[bytes] = set()
        self.ends: dict[tuple[int, int], set[str]] = {}
        for _, words in items:
            self.vocabulary.update(words)
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.sizes = sorted({min(window, len(words)) for _, words in items if words}, reverse=True)
        for item, words in items:
            size = min(window, len(words))
            state = n = 0
            for at, w in enumerate(words):
                state, n = self.step[state][w], n + 1
                if at + 1 >= size > 0:
                    self.ends.setdefault((self.holder(state, size), size), set()).add(item)

    def _extend(self, last: int, w: bytes) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = self._state({}, length[last] + 1, 0)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: bytes, q: int) -> int:
        copy = self._state(dict(self.step[q]), self.length[p] + 1, self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _state(self, step: dict, length: int, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def holder(self, state: int, size: int) -> int:
        """The state of the suffix of ``size`` words of what ``state`` matches."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans ``(start, end)`` of hit words, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.sizes:
            return spans, items
        least, vocabulary = self.sizes[-1], self.vocabulary
        known = np.array([i for i, w in enumerate(words) if w in vocabulary], np.int64)
        for run in np.split(known, np.nonzero(np.diff(known) > 1)[0] + 1):
            if len(run) >= least:
                self._stream(words, int(run[0]), int(run[-1]) + 1, spans, items)
        return spans, items

    def _stream(self, words: list[bytes], start: int, stop: int, spans: list, items: set[str]) -> None:
        step, link, length = self.step, self.link, self.length
        state = n = 0
        for at in range(start, stop):
            w = words[at]
            while state and w not in step[state]:
                state = link[state]
                n = length[state]
            if w in step[state]:
                state, n = step[state][w], n + 1
            for size in self.sizes:
                if size <= n and (found := self.ends.get((self.holder(state, size), size))):
                    items |= found
                    begin = at + 1 - size
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, at + 1))


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS):
    """The benchmark's items in blocks of bounded size; it comes to the driver a partition at a time."""
    block, n = [], 0
    for row in items.select(items[id_col].cast("string"), items[text_col]).toLocalIterator():
        words = words_of(row[1])
        if block and n + len(words) > block_words:
            yield block
            block, n = [], 0
        block.append((row[0] or "", words))
        n += len(words)
    yield block


def merged(a: list, b: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted([*a, *b]):
        if out and out[-1][1] >= x:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, keep_text: bool = False,
) -> DataFrame:
    """``(doc_id, n_words, spans, items)``: spans of hit words as ``[start, end)``, items sorted; the text if asked for."""
    spark = docs.sparkSession
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    rest = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
    out = texts(docs, id_col, text_col)
    blocks = item_blocks(items, item_id, item_text, block_words)
    block = next(blocks)
    while block is not None:
        sent, block = spark.sparkContext.broadcast(ItemAutomaton(block, window)), next(blocks, None)
        with_text = keep_text or block is not None

        def run(batches, sent=sent, with_text=with_text):
            automaton = sent.value
            for batch in slices(batches):
                n_words, spans, found = [], [], []
                before = batch.select(["spans", "items"]).to_pylist() if batch.num_columns > 2 else None
                for i, text in enumerate(batch.column(1)):
                    words = words_of(text.as_py())
                    s, hit = automaton.matches(words)
                    if before:
                        s = merged(s, [(x["start"], x["end"]) for x in before[i]["spans"]])
                        hit = hit | set(before[i]["items"])
                    n_words.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in s])
                    found.append(sorted(hit))
                columns = {"doc_id": batch.column(0)} | ({"text": batch.column(1)} if with_text else {})
                columns |= {"n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, kind), "items": pa.array(found, pa.list_(pa.string()))}
                yield pa.record_batch(list(columns.values()), list(columns))

        out = out.mapInArrow(run, ("doc_id long, text string, " if with_text else "doc_id long, ") + rest)
        if block is not None:
            out = stored(out)
            sent.destroy()
    return out


def uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no window of an item; no shuffle."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    blocks = item_blocks(items, block_words=block_words)
    block = next(blocks)
    while block is not None:
        sent = spark.sparkContext.broadcast(ItemAutomaton(block, window))

        def run(batches, sent=sent):
            for batch in slices(batches):
                clean = [not sent.value.matches(words_of(t.as_py()))[0] for t in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs, block = docs.mapInArrow(run, docs.schema), next(blocks, None)
        if block is not None:
            docs = stored(docs)
            sent.destroy()
    return docs


def _word_places(text: str) -> list[tuple[int, int]]:
    """Where the words of ``words_of`` stand in the text's bytes."""
    data = np.frombuffer(b" " + text.encode().translate(WORD_BYTES) + b" ", np.uint8) != 32
    edges = np.diff(data.astype(np.int8))
    return list(zip(np.nonzero(edges == 1)[0].tolist(), np.nonzero(edges == -1)[0].tolist()))


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans ``[start, end)`` and what stands between them; what is left meets at a blank."""
    data, places, parts, at = text.encode(), _word_places(text), [], 0
    for start, end in spans:
        parts.append(data[at : places[start][0]].rstrip())
        at = places[end - 1][1]
    parts.append(data[at:].lstrip() if spans else data)
    return b" ".join(p for p in parts if p).decode() if spans else text


def without_spans(docs: DataFrame, items: DataFrame, min_words: int = WINDOW, max_share: float = 0.5, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, text)``: without hit spans of ``min_words`` words or more; documents hit beyond ``max_share`` of their words go."""
    hit = contamination(docs, items, window, block_words=block_words, keep_text=True)
    hit = hit.where(word_counts() <= F.lit(max_share) * F.col("n_words")).select("doc_id", "text", "spans")

    def run(batches):
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                long = [(x["start"], x["end"]) for x in spans.as_py() if x["end"] - x["start"] >= min_words]
                out.append(without_words(text.as_py(), long))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return hit.mapInArrow(run, "doc_id long, text string")


def word_counts(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", word_counts().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bi AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0
), bs AS (
  SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM bi
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bs
), ns AS (
  SELECT DISTINCT n FROM bi
), ds AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM ds
), hit AS (
  SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s
), hw AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""
