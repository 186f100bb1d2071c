"""Best-fit packing of token sequences, in rounds over a tree of partitions.

Documents are tokenised once; what is longer than a sequence is cut. Every partition packs its pieces by
best fit, longest first, in blocks of bounded size, and lets go of the bins that are nearly full. The
underfull ones are the next round's items, merged into fewer partitions, until one block holds them all. Before each
round the bins leave that cannot take the smallest item of all, and no item can take: those of long pieces mostly. While more
than a block is left, rounds deal the items anew, at random; only when ``STALLED`` rounds on end have joined no two items in
any block are they closed as they are. A bin carries its members, so no join is needed to know where a piece went.

Defined cases: a null text is an empty document, which is its end token alone; repeated rows are packed each;
null doc_ids are kept; an empty table gives no rows; the name of an added token in a text (``<|endoftext|>``) is that
token's id, as the ``tokenizers`` file of the vocabulary has it.
"""

from __future__ import annotations

import base64
import functools
import itertools
import json
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, slices, stored, texts

LENGTH = 2048
END_ID = 0
BLOCK = 100_000
#: A bin with no more room than this is closed at once.
NEARLY = 16
#: Rounds without any two items joined, each with the items dealt anew, after which no more are tried.
STALLED = 3
CACHED = 200_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBER = "doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint"


class Irregular(Exception):
    """The text has white space other than single blanks between words."""


class WordIds(dict):
    """Ids of a blank and a word, as little-endian 32-bit numbers.

    A byte-level BPE never joins tokens across a blank that stands alone between two words, so the ids of a
    text are those of its words, and most words repeat.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise Irregular
        if len(self) >= CACHED:
            self.clear()
        found = self[word] = np.array(self.encode(" " + word), "<u4").tobytes()
        return found

    def of(self, text: str) -> np.ndarray:
        first, *rest = text.split(" ")
        try:
            if rest and (not first or first[-1].isspace()):
                raise Irregular
            head = np.array(self.encode(first), "<u4").tobytes()
            return np.frombuffer(head + b"".join([self[w] for w in rest]), "<u4")
        except Irregular:
            return np.array(self.encode(text), "<u4")


@functools.cache
def word_ids(vocabulary: str, pattern: str) -> WordIds:
    """One per Python worker; ``vocabulary`` is a file of base64 tokens and their ranks."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return WordIds(tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@functools.cache
def added_tokens(path: str) -> dict[str, int]:
    """Names and ids of the tokens that a ``tokenizers`` file adds to its vocabulary; they are found before words are cut."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    odd = [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens that take more than their own name: {odd}")
    return {t["content"]: t["id"] for t in tokens}


def default_added() -> dict[str, int]:
    import public_tokenizers

    return added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def text_ids(encoder: WordIds, text: str, added: dict[str, int]) -> np.ndarray:
    """Ids of a text in which the names of added tokens may occur."""
    if not any(name in text for name in added):
        return encoder.of(text)
    # Of names that begin at the same place, the longest one.
    names = "|".join(re.escape(name) for name in sorted(added, key=len, reverse=True))
    parts = re.split(f"({names})", text)
    ids = [np.array([added[p]], "<u4") if i % 2 else encoder.of(p) for i, p in enumerate(parts) if p]
    return np.concatenate(ids)


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces; only the first may be shorter."""
    first = n % length or length
    return [(0, first), *((at, length) for at in range(first, n, length))] if n > length else [(0, n)]


def token_pieces(
    docs: DataFrame, length: int = LENGTH, vocabulary: tuple[str, str] | None = None,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, added: dict[str, int] | None = None,
) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32``, and the ids where asked for.

    ``added`` has the added tokens of a ``vocabulary`` of the caller's own; the default one brings its own.
    """
    added = (added or {}) if vocabulary else default_added()
    vocabulary = vocabulary or default_vocabulary()

    def run(batches):
        encoder = word_ids(*vocabulary)
        end = np.array([END_ID], "<u4")
        for batch in slices(batches):
            rows, ids_out = [], []
            for at, text in enumerate(batch.column(1)):
                ids = np.concatenate([text_ids(encoder, text.as_py() or "", added), end])
                for piece, (start, n) in enumerate(cuts(len(ids), length)):
                    part = ids[start : start + n]
                    rows.append((at, piece, start, n, zlib.crc32(part.tobytes())))
                    ids_out.append(part) if keep_ids else None
            at, piece, start, n, crc = zip(*rows) if rows else ((),) * 5
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (start, n, crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array([p.astype(np.int32) for p in ids_out], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names)

    return texts(docs, id_col, text_col).mapInArrow(run, PIECE + (", ids array<int>" if keep_ids else ""))


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, goes where the least room is left that holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r is set where by_room[r] has bins
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[at].append(item)
        else:
            room, at = length, len(bins)
            bins.append([item])
        room -= size
        if room:
            by_room[room].append(at)
            rooms |= 1 << room
    return bins


def _packed(block: pa.Table, length: int, last: bool) -> pa.RecordBatch:
    """One best-fit round over a block of items ``(fill, members)``."""
    block = block.combine_chunks()
    fill = block.column("fill").to_numpy()
    members = block.column("members").combine_chunks()
    starts = members.offsets.to_numpy().astype(np.int64)
    bins = best_fit(fill, length)
    order = np.fromiter(itertools.chain.from_iterable(bins), np.int64, len(fill))
    counts = np.array([len(b) for b in bins], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    # Where each item begins in its bin, then where each member does.
    before = np.concatenate([[0], np.cumsum(fill[order])])
    base = before[:-1] - np.repeat(before[first[:-1]], counts)
    sizes = (starts[1:] - starts[:-1])[order]
    ends = np.cumsum(sizes)
    take = np.arange(int(sizes.sum())) + np.repeat(starts[:-1][order] - (ends - sizes), sizes)
    rows = members.values.take(pa.array(take))
    fields = {f.name: rows.field(f.name) for f in rows.type}
    fields["offset"] = pa.array(fields["offset"].to_numpy() + np.repeat(base, sizes))
    offsets = np.concatenate([[0], ends])[first]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
    fills = np.add.reduceat(fill[order], first[:-1]) if len(bins) else np.zeros(0, np.int64)
    is_open = (fills < length - NEARLY) & (not last)
    return pa.record_batch([pa.array(fills), lists, pa.array(is_open)], ["fill", "members", "open"])


def pack(pieces: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces ``(doc_id, piece, start, length, ids_crc32)``."""
    spark = pieces.sparkSession
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"fill bigint, members array<struct<{MEMBER}>>, open boolean"

    def run(batches, last):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block and not last:
                yield _packed(pa.Table.from_batches(held), length, last)
                held, n = [], 0
        if n:
            yield _packed(pa.Table.from_batches(held), length, last)

    items = pieces.select(F.col("length").alias("fill"), F.array(F.struct(*columns, F.lit(0).cast("long").alias("offset"))).alias("members"))
    closed = [items.where(F.col("fill") >= length)]
    rest = items.where(F.col("fill") < length)
    before, parts, stalled = None, None, 0
    while True:
        last = parts == 1
        done = stored(rest.mapInArrow(functools.partial(run, last=last), schema))
        closed.append(done.where("not open").select("fill", "members"))
        rest = done.where("open").select("fill", "members")
        n, least = rest.agg(F.count(F.lit(1)), F.min("fill")).first()
        if n == 0:
            break
        # A bin without room for the smallest item takes none, and is too large for any other's room.
        closed.append(rest.where(F.col("fill") > length - least))
        rest = rest.where(F.col("fill") <= length - least)
        n = rest.count()
        stalled = stalled + 1 if n == before else 0
        before = n
        least_parts = math.ceil(n / block)
        if n < 2 or stalled == STALLED:
            closed.append(rest)
            break
        parts = max(1, least_parts) if parts is None else max(1, least_parts, parts // 2)
        rest = rest.coalesce(1) if parts == 1 else rest.repartition(parts, F.rand(parts + stalled))
    bins = functools.reduce(DataFrame.unionByName, closed)
    bins = bins.withColumn("sequence_id", F.monotonically_increasing_id())
    rows = bins.select("sequence_id", F.explode("members").alias("m"))
    return rows.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def packed_documents(docs: DataFrame, length: int = LENGTH, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    return pack(stored(token_pieces(docs, length, vocabulary)), length)


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))
