"""Near-duplicate groups for the corpus pipeline: SimHash candidates, verified.

A text is its set of distinct five-word shingles; two documents are near copies when their sets have a Jaccard
similarity of 0.8 or more, and groups are the connected components of these pairs.

1. Equal sets (by SHA-256) are one node; nothing is left to verify there.
2. A node's fingerprint has the majority bits of its shingles' hashes, in 3 words of 64 bits. Sets as alike are of sizes
   as alike, so nodes are cut into bands of sizes, and the tiles of a band meet those of their own and the next one as in
   the SimHash operator: all their pairs are compared by exclusive-or and bit counts. The radius of 52 bits is so far that
   a pair at 0.8 is beyond it about once in 100,000 (by the binomial odds of a bit that differs, 0.152; once in 1,000 for
   texts of 8 or 9 words); pairs that are more alike are missed more rarely still.
3. Links are verified on the sets. Tiles return each node's closest partners, which are combined to its closest of all, one at
   first; nodes without any candidate leave then, and the others get fingerprints of 16 words, which tell near copies from mere
   relatives better. Next the ``PARTNERS`` closest of those that are not of its group yet. Pairs beyond that are between nodes that
   both have more, the dense ones: their sets go with the tiles, and a task verifies all that is left of their pairs, closest ones
   first and none within a group that has grown so far, and returns only the links that join two groups. So the sets that are
   joined are linear in the nodes (a row of three numbers for each node and pair of tiles comes before that), and no pair of
   different groups is left untried.

Defined cases: null and empty texts and texts without words are near copies of none; texts of fewer words than a shingle are
one shingle; rows without a doc_id are left out (the stage numbers its rows where there are any); rows that repeat a
doc_id count once for each of their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import by_id, slices, stored, texts
from brightledger.llm.components import connected_components
from brightledger.llm.repeats import text_arrays
from brightledger.llm.simhash import LOWER, STRIP, TILE, fingerprint, tile_pairs
from brightledger.llm.spans import mixed, shingles

SHINGLE, SIMILARITY = 5, 0.8
#: Bits that may differ in fingerprints of so many words, and in the first word, which is compared first.
RADIUS, FIRST = {3: 52, 16: 212}, 25
#: Partners of a node that the second round tries in each pair of tiles, and shingles of a tile of dense nodes.
PARTNERS, DENSE_TILE = 2, 2_000_000
#: Covers rounding where a bound on whole numbers is computed in doubles; it only lets more pairs be verified.
ROUNDING = 1e-6


def print_names(words: int) -> list[str]:
    return [f"w{i}" for i in range(words)]


def fingerprint_words(own: np.ndarray, words: int) -> list[int]:
    """The fingerprint of a set of shingle hashes, word by word; each word takes its bits from other hashes of them."""
    found = []
    for i in range(words):
        found.append(fingerprint(own))
        own = mixed(own + np.uint64(i + 1))
    return found


def shingle_sets(docs: DataFrame, size: int, words: int, keep: bool) -> DataFrame:
    """``(doc_id, n, digest, shingles, w0, ...)`` of each text's set of shingles; the set itself only where it is to be kept."""

    def run(batches):
        for batch in slices(batches):
            ids, data, bounds = text_arrays(batch)
            sets = shingles(LOWER[data], bounds, size)
            prints = np.array([fingerprint_words(own, words) for own in sets], np.uint64).reshape(-1, words).view(np.int64)
            kept = pa.array([own.view(np.int64) for own in sets] if keep else [None] * len(sets), pa.list_(pa.int64()))
            digests = pa.array([hashlib.sha256(own.astype("<u8").tobytes()).digest() for own in sets], pa.binary())
            columns = [pa.array(ids), pa.array([len(own) for own in sets], pa.int64()), digests, kept]
            yield pa.record_batch([*columns, *(pa.array(w) for w in prints.T)], ["doc_id", "n", "digest", "shingles", *print_names(words)])

    schema = "doc_id long, n long, digest binary, shingles array<long>, " + ", ".join(f"{w} long" for w in print_names(words))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _closest(ends: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Which links are among the ``most`` closest of their end."""
    order = np.lexsort((far, ends))
    sorted_ = ends[order]
    begins = np.ones(len(ends), bool)
    begins[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(len(ends), np.int64)
    rank[order] = np.arange(len(ends)) - np.nonzero(begins)[0][np.cumsum(begins) - 1]
    return rank < most


def candidate_strips(a: dict, b: dict, same: bool, similarity: float, words: int):
    """``(p, q, far)`` of the points of two tiles that may be near copies and are of different groups, a strip of ``a`` at a time.

    Both are in the order of sizes, so a strip meets only the sizes of ``b`` that can agree.
    """
    for at in range(0, len(a["n"]), STRIP):
        here = slice(at, at + STRIP)
        sizes = a["n"][here]
        low, high = np.searchsorted(b["n"], [similarity * sizes[0] - ROUNDING, sizes[-1] / similarity + ROUNDING])
        if same:
            low = max(low, at)
        p, q = np.nonzero(np.bitwise_count(a["w0"][here, None] ^ b["w0"][None, low:high]) <= FIRST)
        p, q = p + at, q + low
        n, m = a["n"][p], b["n"][q]
        keep = (np.minimum(n, m) >= similarity * np.maximum(n, m) - ROUNDING) & (a["component"][p] != b["component"][q])
        if same:
            keep &= q > p
        p, q = p[keep], q[keep]
        far = sum(np.bitwise_count(a[w][p] ^ b[w][q]).astype(np.int64) for w in print_names(words))
        keep = far <= RADIUS[words]
        yield p[keep], q[keep], far[keep]


def closest_links(a: dict, b: dict, same: bool, similarity: float, words: int, most: int) -> tuple[np.ndarray, ...]:
    """``(node, far, partner)`` of the ``most`` closest candidates of each point of two tiles; nodes that have more have a row with themselves."""
    counts = np.zeros(len(a["n"]), np.int64), np.zeros(len(b["n"]), np.int64)
    found = [(np.zeros(0, np.int64),) * 3]
    for strip in candidate_strips(a, b, same, similarity, words):
        for count, ends in zip(counts, strip):
            count += np.bincount(ends, minlength=len(count))
        found.append(strip)
        if len(found) > 16:
            found = [_kept(found, most)]
    p, q, far = _kept(found, most)
    mine, theirs = _closest(p, far, most), _closest(q, far, most)
    more = np.unique(np.concatenate([a["node"][counts[0] > most], b["node"][counts[1] > most]]))
    u, v = a["node"][p], b["node"][q]
    return np.concatenate([u[mine], v[theirs], more]), np.concatenate([far[mine], far[theirs], np.zeros_like(more)]), np.concatenate([v[mine], u[theirs], more])


def _kept(found: list, most: int) -> tuple:
    p, q, far = (np.concatenate(c) for c in zip(*found))
    keep = _closest(p, far, most) | _closest(q, far, most) if len(p) else np.zeros(0, bool)
    return p[keep], q[keep], far[keep]


def joining_links(a: dict, b: dict, same: bool, similarity: float, words: int) -> tuple[list, list]:
    """Verified links that join two groups; pairs of one group, as far as it has grown here, are passed over."""
    names, parts = np.unique(np.concatenate([a["component"], b["component"]]), return_inverse=True)
    ours, theirs = parts[: len(a["n"])].tolist(), parts[len(a["n"]) :].tolist()
    root = list(range(len(names)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    us, vs = [], []
    for p, q, far in candidate_strips(a, b, same, similarity, words):
        order = np.argsort(far, kind="stable")
        for i, j in zip(p[order].tolist(), q[order].tolist()):
            x, y = find(ours[i]), find(theirs[j])
            if x != y and alike(a["shingles"][i], b["shingles"][j], similarity):
                root[max(x, y)] = min(x, y)
                us.append(int(a["node"][i]))
                vs.append(int(b["node"][j]))
    return us, vs


def alike(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    common = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
    return common >= similarity * (len(one) + len(two) - common) - ROUNDING


def _tile(rows: pa.StructArray, words: int) -> dict:
    """A tile's columns as arrays, in the order of sizes."""
    order = np.argsort(rows.field("n").to_numpy(), kind="stable")
    found = {}
    for field in rows.type:
        column = rows.field(field.name)
        if field.name == "shingles":
            ends = np.cumsum(column.value_lengths().to_numpy())
            sets = np.split(column.flatten().to_numpy().view(np.uint64), ends[:-1])
            found["shingles"] = [sets[i] for i in order.tolist()]
        else:
            found[field.name] = column.to_numpy(zero_copy_only=False)[order]
    return found | {w: found[w].view(np.uint64) for w in print_names(words)}


def band_pairs(points: DataFrame, similarity: float, tile: int, within: list[str] | None = None, weight=None) -> DataFrame:
    """The pairs of tiles, along bands of set sizes, whose sizes can agree."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(similarity)) + F.lit(ROUNDING)).cast("long")
    return tile_pairs(points.withColumn("cell", band), [0, 1], tile, within, weight)


def band_candidates(points: DataFrame, similarity: float, words: int, most: int, tile: int = TILE, within: list[str] | None = None) -> DataFrame:
    """``(node, far, partner)`` of points ``(node, n, w0, ..., component)``: a node's ``most`` closest candidates in each pair of tiles, itself where it has more."""

    def run(batches):
        for batch in slices(batches, 1):
            a, b = (_tile(batch.column(i)[0].values, words) for i in (0, 1))
            found = closest_links(a, b, batch.column(2)[0].as_py(), similarity, words, most)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in found], ["node", "far", "partner"])

    return band_pairs(points, similarity, tile, within).mapInArrow(run, "node long, far long, partner long")


def closest_over_all(candidates: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """``(u, v)`` of each node's ``most`` closest candidates over all pairs of tiles, and the ``node``s that have more.

    A pair that is left out is one of two nodes that both have more. What tiles found is a few numbers for each row, combined by node before
    any set is looked up, so the sets that are joined grow with the nodes alone.
    """
    kept, left = None, candidates.where("partner <> node")
    for _ in range(most):
        best = left.groupBy("node").agg(F.min(F.struct("far", "partner")).alias("b")).select("node", F.col("b.partner").alias("partner"))
        kept = best if kept is None else kept.unionByName(best)
        left = left.join(best, ["node", "partner"], "left_anti")
    links = kept.select(F.least("node", "partner").alias("u"), F.greatest("node", "partner").alias("v")).distinct()
    return links, candidates.where("partner = node").select("node").unionByName(left.select("node")).distinct()


def band_links(points: DataFrame, similarity: float, words: int, tile: int = DENSE_TILE, within: list[str] | None = None) -> DataFrame:
    """Verified links ``(u, v)`` between points that bring their ``shingles``, as many as join groups."""

    def run(batches):
        for batch in slices(batches, 1):
            a, b = (_tile(batch.column(i)[0].values, words) for i in (0, 1))
            us, vs = (pa.array(x, pa.int64()) for x in joining_links(a, b, batch.column(2)[0].as_py(), similarity, words))
            yield pa.record_batch([pc.min_element_wise(us, vs), pc.max_element_wise(us, vs)], ["u", "v"])

    return band_pairs(points, similarity, tile, within, F.col("n")).mapInArrow(run, "u long, v long")


def verified(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links ``(u, v)`` whose documents' sets are as alike."""
    one, two = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = links.join(one, "u").join(two, "v")
    common = F.size(F.array_intersect("a", "b"))
    alike = (common >= F.lit(similarity) * (F.size("a") + F.size("b") - common) - F.lit(ROUNDING)) & (F.size("a") + F.size("b") > 0)
    return both.where(alike).select("u", "v")


def near_copies(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, within: list[str] | None = None) -> DataFrame:
    """``(doc_id, component)`` of every document with a near copy; the component is the smallest doc_id of its group."""
    rows = texts(docs).where("doc_id is not null")
    words, fine = RADIUS
    prints = stored(shingle_sets(rows, size, words, keep=False).where("n > 0").drop("shingles"), within=within)
    nodes = prints.groupBy("digest", "n", *print_names(words)).agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes, within=within)
    copied = nodes.where("copies > 1").select("digest", F.col("node").alias("v"))
    same = prints.select("digest", F.col("doc_id").alias("u")).join(stored(copied, within=within), "digest")
    found = stored(same.where("u > v").select("u", "v").distinct(), within=within)
    groups = connected_components(found)

    def labelled(points: DataFrame) -> DataFrame:
        rows = points.join(groups.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
        return rows.withColumn("component", F.coalesce("component", "node")).drop("member")

    def grown(more: DataFrame) -> DataFrame:
        # What is joined already is a star for each group: few links for the next round.
        stars = groups.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
        return connected_components(stars.unionByName(more))

    seen = stored(band_candidates(labelled(nodes.drop("digest", "copies")), similarity, words, 1, within=within), within=within)
    if not seen.isEmpty():
        # Nodes with a candidate: pairs of others are none.
        ends = stored(seen.select(F.col("node").alias("doc_id")).distinct(), within=within)
        sets = stored(shingle_sets(by_id(rows, ends, "left_semi"), size, fine, keep=True), within=within)
        first = stored(closest_over_all(seen, 1)[0], within=within)
        groups = grown(stored(verified(first, sets, similarity), within=within))
        points = sets.drop("digest").withColumnRenamed("doc_id", "node")
        seen = stored(band_candidates(labelled(points.drop("shingles")), similarity, fine, PARTNERS, within=within), within=within)
        next_, dense = closest_over_all(seen, PARTNERS)
        tried = next_.join(first, ["u", "v"], "left_anti")
        groups = grown(stored(verified(tried, sets, similarity), within=within))
        dense = stored(dense, within=within)
        if not dense.isEmpty():
            left = labelled(points.join(dense, "node", "left_semi"))
            groups = grown(stored(band_links(left, similarity, fine, within=within), within=within))
    return groups.select(F.col("node").alias("doc_id"), "component")
