"""SimHash near-dedup by tiled exact comparison.

A document's 64-bit fingerprint has a bit set where more than half of its shingle hashes (XXH64, seed 42)
have it. Equal fingerprints are merged first, so copies cost nothing further. Distinct fingerprints are
dealt into tiles of bounded size, and two tiles meet in one task, which compares all their pairs with numpy
exclusive-or and bit counts. Tiles are cut along the population counts of the fingerprint's four 16-bit
parts: two fingerprints within the radius differ in these counts by no more than the radius altogether, so
tile pairs beyond that are never formed. A task returns a spanning forest of the links that it finds, never
all pairs of a group, so links stay linear in the fingerprints while components lose nothing.

Defined cases: null and empty texts and texts without words have fingerprint zero and link like any other;
fewer words than a shingle make one shingle; a repeated row gets a row each; a null doc_id keeps its row and
is ignored as a smallest one; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import ASCII_LOWER, read, slices, stored, texts
from brightledger.llm.components import connected_components

SEED = 42
LOWER = np.frombuffer(ASCII_LOWER, np.uint8)
TILE, STRIP = 16_384, 64
#: Part counts are 0 to 16; with 2 added on both sides, neighbours' codes never carry over in base 32.
BASE = 32
#: Hashes counted at once: as many as a byte can count.
ROUND = 255


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased words, repeats included."""
    words = text.encode().translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    k = min(size, len(words))
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts, stops[k - 1 :])), np.uint64, len(words) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, as an unsigned number; long texts are taken in rounds."""
    counts = np.zeros(64, np.int64)
    data = np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(hashes), ROUND):
        counts += np.add.reduce(np.unpackbits(data[at : at + ROUND], axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, fp)`` of ``(doc_id, text)`` rows; ``fp`` as a signed long."""

    def run(batches):
        for batch in slices(batches):
            fps = [fingerprint(shingle_hashes(text.as_py() or "", size)) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def part_counts(fp: str = "fp") -> list:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(65535))).cast("long") for i in range(4)]


def part_offsets(radius: int) -> list[int]:
    """Half of the cells that a cell's fingerprints can link to, itself first."""
    around = range(-radius, radius + 1)
    steps = [(a, b, c, d) for a in around for b in around for c in around for d in around if abs(a) + abs(b) + abs(c) + abs(d) <= radius]
    codes = [((a * BASE + b) * BASE + c) * BASE + d for a, b, c, d in steps]
    return sorted(x for x in codes if x >= 0)


class Forest:
    """Parts of ``n`` points that links have joined so far."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of the links, in order, that join two parts."""
        open_ = np.nonzero(self.root[a] != self.root[b])[0]
        moved: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := moved.get(x, x)) != x:
                moved[x] = moved.get(up, up)
                x = up
            return x

        kept = []
        for at, x, y in zip(open_.tolist(), self.root[a[open_]].tolist(), self.root[b[open_]].tolist()):
            x, y = find(x), find(y)
            if x != y:
                moved[max(x, y)] = min(x, y)
                kept.append(at)
        for x in moved:
            self.root[x] = find(x)
        self.root = self.root[self.root]
        return np.array(kept, np.int64)


def linked(x: np.ndarray, y: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles' fingerprints, by number: a spanning forest.

    ``x`` is taken in strips, so what is held stays small however dense the links are.
    """
    parts = Forest(len(x) if same else len(x) + len(y))
    out_a, out_b = [], []
    for at in range(0, len(x), STRIP):
        far = np.bitwise_count(x[at : at + STRIP, None] ^ y[None, :])
        a, b = np.nonzero(far <= radius)
        if same:
            after = b > a + at
            a, b = a[after], b[after]
        a = a + at
        keep = parts.add(a, b if same else b + len(x))
        out_a.append(a[keep])
        out_b.append(b[keep])
    return np.concatenate(out_a), np.concatenate(out_b)


def tile_pairs(points: DataFrame, offsets: list[int], tile: int = TILE, within: list[str] | None = None, weight=None) -> DataFrame:
    """``(a, b, same)``: the tiles that are to be compared, as arrays of the points' columns.

    A point of cell ``c`` is compared with those of the cells ``c + offset``; ``offsets`` holds one of each pair of
    opposite neighbours. Cells are cut into tiles of about ``tile`` points (or so much ``weight``) by a hash of the node; every pair of tiles
    has a key of its own, so that those of a dense cell spread over the tasks.
    """
    cells = points.groupBy("cell").agg(F.ceil(F.sum(F.lit(1) if weight is None else weight) / F.lit(tile)).cast("int").alias("cuts"))
    # Cells are few by their making, whatever the rows: at most 17 ** 4 of part counts, a few hundred of size bands.
    cells = F.broadcast(stored(cells, within=within))
    columns = [c for c in points.columns if c != "cell"]
    cut = points.join(cells, "cell").withColumn("cut", F.pmod(F.xxhash64("node"), "cuts").cast("int"))
    tiles = stored(cut.groupBy("cell", "cut").agg(F.collect_list(F.struct(*columns)).alias("rows")), within=within)
    left = tiles.select(
        F.col("rows").alias("a"), F.col("cell").alias("own"), F.col("cut").alias("cut_a"),
        F.explode(F.array(*[F.col("cell") + F.lit(x) for x in offsets])).alias("cell"),
    ).join(cells, "cell")
    first = F.when(F.col("cell") == F.col("own"), F.col("cut_a")).otherwise(0)
    left = left.withColumn("cut", F.explode(F.sequence(first, F.col("cuts") - 1)))
    met = left.join(tiles.withColumnRenamed("rows", "b"), ["cell", "cut"])
    return met.select("a", "b", ((F.col("cell") == F.col("own")) & (F.col("cut_a") == F.col("cut"))).alias("same"))


def tile_links(points: DataFrame, offsets: list[int], radius: int, tile: int = TILE) -> DataFrame:
    """Links ``(u, v)`` of ``points(node, fp, cell)`` within the radius, as forests of tile pairs."""

    def run(batches):
        for batch in slices(batches, 1):
            a, b = batch.column(0)[0].values, batch.column(1)[0].values
            x, y = (t.field("fp").to_numpy(zero_copy_only=False).view(np.uint64) for t in (a, b))
            p, q = linked(x, y, batch.column(2)[0].as_py(), radius)
            nodes = [t.field("node").to_numpy(zero_copy_only=False) for t in (a, b)]
            yield pa.record_batch([pa.array(nodes[0][p]), pa.array(nodes[1][q])], ["u", "v"])

    return tile_pairs(points, offsets, tile).mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)``, a row for every input row."""
    prints = stored(fingerprints(texts(docs, id_col, text_col), size))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    a, b, c, d = part_counts()
    cell = (((a + 2) * BASE + b + 2) * BASE + c + 2) * BASE + d + 2
    links = tile_links(nodes.where("node is not null").withColumn("cell", cell), part_offsets(radius), radius)
    named = nodes.join(connected_components(links), "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(stored(named), "fp", "left").select("doc_id", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
