"""The near-duplicate stage against all pairs: template groups, repeated passages, and one shingle that drowns the rest."""

import random

from brightledger.llm import near_stage, simhash


def components(rows):
    """The group of every document with a near copy, by comparing all pairs."""
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    alike = [(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for a, b in alike:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for pair in alike for i in pair}


def found(spark, rows):
    got = near_stage.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    return {r.doc_id: r.component for r in got}


def words(r, n):
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def test_pairs_in_a_template_group(spark):
    """Documents that share 70 % of their text, some of which have a near copy of about 0.82 among the others."""
    r = random.Random(7)
    template, rows = words(r, 165), []
    for i in range(200):
        own = words(r, 40)
        rows.append((i, " ".join(template + own)))
        if i < 50:
            rows.append((1000 + i, " ".join(template + own[:19] + words(r, 21))))
    want = components(rows)
    assert len(want) >= 80
    assert found(spark, rows) == want


def test_no_pair_at_the_threshold_is_missed(spark):
    r = random.Random(8)
    rows = []
    for i in range(150):
        n = r.choice((30, 64, 204))
        base, k = words(r, n), r.randint(round(0.85 * n), n)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:k] + words(r, n - k)))]
    want = components(rows)
    assert 50 < len(want) < 300
    assert found(spark, rows) == want


def test_repeated_passages_do_not_count(spark):
    """A paragraph that one copy repeats leaves the set, and so the similarity, as it is."""
    r = random.Random(9)
    rows = []
    for i in range(20):
        body, line = words(r, 120), words(r, 12)
        rows += [(2 * i, " ".join(body + line)), (2 * i + 1, " ".join(body + line * 60))]
    want = components(rows)
    assert len(want) == 40
    assert found(spark, rows) == want


def test_copies_that_their_first_is_not_like(spark):
    """One shingle makes most of every text, so fingerprints and sizes are equal, but only some tails are alike."""
    r = random.Random(10)
    tail, other = words(r, 60), words(r, 60)
    rows = [(0, " ".join(["na"] * 400 + words(r, 60)))]
    rows += [(i, " ".join(["na"] * 400 + (tail if i % 2 else other)[:-1] + words(r, 1))) for i in range(1, 9)]
    assert len({simhash.fingerprint(simhash.shingle_hashes(t, 5)) for _, t in rows}) == 1
    want = components(rows)
    assert len(want) == 8 and len(set(want.values())) == 2
    assert found(spark, rows) == want


def test_short_texts(spark):
    """Sets of 1 to 40 shingles at and about the threshold."""
    r = random.Random(11)
    rows = []
    for i in range(200):
        base = words(r, r.randint(3, 44))
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base + words(r, r.randint(0, 1 + len(base) // 5))))]
    want = components(rows)
    assert 100 < len(want) < 400
    assert found(spark, rows) == want


def test_dense_groups(spark, monkeypatch):
    """Many relatives of one text, some of them near copies of each other but not of it; in tiles of any size."""
    r = random.Random(12)
    base, rows = words(r, 150), []
    for i in range(120):
        own = list(base)
        for at in r.sample(range(150), r.choice((1, 1, 2, 4))):
            own[at] = words(r, 1)[0]
        rows.append((i, " ".join(own)))
    want = components(rows)
    assert len(want) > 60 and found(spark, rows) == want
    run = near_stage.tile_pairs
    monkeypatch.setattr(near_stage, "tile_pairs", lambda points, offsets, tile, *more: run(points, offsets, tile // 1000, *more))
    assert found(spark, rows) == want


def test_no_texts(spark):
    assert found(spark, [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f")]) == {}
    assert near_stage.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_candidates_are_as_many_as_nodes(spark):
    """Of documents that share most of their text each keeps its closest one over all tiles, however many tiles there are."""
    r = random.Random(11)
    template, rows = words(r, 160), []
    for i in range(300):
        rows.append((i, " ".join(template + words(r, 40))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = near_stage.shingle_sets(docs, 5, 3, keep=False).drop("shingles", "digest").withColumnRenamed("doc_id", "node").selectExpr("*", "node AS component").cache()
    want = None
    for tile in (1000, 60, 20):
        seen = near_stage.band_candidates(prints, 0.8, 3, 1, tile=tile).cache()
        links, more = near_stage.closest_over_all(seen, 1)
        got = sorted(map(tuple, links.collect())), sorted(x.node for x in more.collect())
        assert want in (None, got) and 100 < len(got[0]) <= 300
        want = got
    assert seen.count() > 2 * len(want[0])  # tiles found more than that
    w = {x.node: [x.w0, x.w1, x.w2] for x in prints.collect()}

    def far(a, b):
        return sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(w[a], w[b]))

    closest = {a: min((far(a, b), b) for b in w if b != a) for a in w}
    assert {(min(a, b), max(a, b)) for a, (n, b) in closest.items() if n <= 52} >= set(want[0])
