"""Fingerprints, whitening and resampling, against brute force."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from brightledger.llm import fingerprints, resampling, whitening

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_features(text):
    words = WORD.findall(lower(text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_resampled(docs, items, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for counts, rows in ((s, [x for _, x in docs]), (t, items)):
        for text in rows:
            for f in brute_features(text)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(sum(s) + buckets) / (float(s[b] + 1) * float(sum(t) + buckets)))) for b in range(buckets)]
    out, able = [], []
    for i, text in docs:
        words, features = brute_features(text)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words) >= 20:
                able.append((-score, i, len(features)))
        out.append([i, len(features), weight, score])
    drawn = sorted(able)[: 25 * len(able) // 100]
    ranks = {}
    for place, (_, i, n) in enumerate(drawn, 1):
        ranks.setdefault((i, n), []).append(place)
    return sorted(([*r, ranks[r[0], r[1]].pop(0) if ranks.get((r[0], r[1])) else None] for r in out), key=repr)


ODD = [
    (None, "no id but more than twenty words " * 5), (1, None), (2, ""), (3, " \n\t.,;"), (4, "ÀÉ ÉÀ 中文，字 🙂 x1y2 " * 9), (4, "ÀÉ ÉÀ 中文，字 🙂 x1y2 " * 9),
    (5, "Upper UPPER upper_case a-b c\x00d " * 12), (5, "another text of the same id " * 11), (6, "one"), (7, "w" * 3000), (-8, "minus eight words here " * 10),
]


def frame(spark, rows):
    wide = [(i, t, 1, "x", 2, 3, 0.5, "y") for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, n int, bucket string, place int, __part int, score double, h string")


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_resampling(spark, monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    r = random.Random(5)
    docs = ODD + [(100 + i, " ".join(r.choice(["alpha", "beta", "gamma", "delta", "pi"]) for _ in range(r.randint(1, 80)))) for i in range(60)]
    items = ["alpha beta gamma", "pi pi pi", None, ""]
    got = resampling.resampled(frame(spark, docs).repartition(5), spark.createDataFrame([(t, 1) for t in items], "text string, n int"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted((list(x) for x in got.collect()), key=repr) == brute_resampled(docs, items)


def test_resampling_pieces(monkeypatch):
    """A text that is cut into pieces has the features of the whole, for runs of any length, and a very long one too."""
    text = "Some words, of a text that goes on " * 40
    long = " ".join(f"w{i % 977}" for i in range(700_000))
    for size in (1, 2, 3, 4):
        for t, piece in ((text, 1), (text, 30), (long, 1 << 20)):
            monkeypatch.setattr(resampling, "PIECE", piece)
            found = [[], *([] for _ in range(size))]
            for k, sums in resampling.feature_sums(t, size):
                found[k] += sums
            words = WORD.findall(lower(t))
            for k in range(1, size + 1):
                assert found[k] == [zlib.crc32(" ".join(words[i : i + k]).encode()) for i in range(len(words) - k + 1)]
        if size > 2:
            break


def test_resampling_nothing(spark):
    items = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resampled(frame(spark, []), items).count() == 0
    docs = [(1, "a b " * 20), (2, "c d " * 20), (3, "x"), (4, "e f " * 20), (5, "g h " * 20)]
    assert [tuple(x) for x in resampling.resampled(frame(spark, docs), items.limit(0)).orderBy("doc_id").collect()] == [tuple(x) for x in brute_resampled(docs, [])]


def test_places_are_dealt_over_parts(spark):
    """Rows that the order leaves equal take places of their own, over several parts."""
    from pyspark.sql import functions as F

    from brightledger.llm.common import numbered

    rows = spark.range(4000, numPartitions=7).select((F.col("id") % 2).alias("v"), (F.col("id") % 5 > 0).alias("some"))
    got = numbered(rows, F.desc("v"), only=F.col("some")).collect()
    placed = sorted((r.place, r.v) for r in got if r.place is not None)
    assert [p for p, _ in placed] == list(range(1, 3201)) and [v for _, v in placed] == [1] * 1600 + [0] * 1600
    assert {r.n_placed for r in got} == {3200} and sum(r.place is None for r in got) == 800


# --- fingerprints


def brute_edits(rows):
    """Rows in order of ids, each with its edited and its next text."""
    rows = [(i, t or "") for i, t in rows]
    for at, (i, text) in enumerate(rows):
        then = rows[(at + 1) % len(rows)][1]
        q = len(text) // 4
        yield i, text, text[: len(text) - q] + then[:q], then


def test_edits(spark):
    rows = sorted({i: t for i, t in ODD if i is not None}.items()) + [(50 + i, "Text of some length, " * i + f"its end {i}") for i in range(40)]
    rows.append((99, "x𐐷é\x00" * 9000))
    want = {i: (text, edited, then) for i, text, edited, then in brute_edits(rows)}
    for parts in (1, 3, 200):
        got = fingerprints.edited_documents(frame(spark, rows).repartition(6), parts=parts).collect()
        assert sorted(r.doc_id for r in got) == [i for i, _ in rows]
        for r in got:
            text, edited, then = want[r.doc_id]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            mine, other, next_ = map(fingerprints.fingerprint, (text, edited, then))
            assert (r.fingerprint, r.edited_fingerprint) == (mine.hex(), other.hex())
            assert r.near_edited == fingerprints.likeness(mine, other) and r.near_next == fingerprints.likeness(mine, next_)
            assert r.common_edited == len(os.path.commonprefix([text, edited])) and r.common_next == len(os.path.commonprefix([text, then]))


def test_edits_of_odd_rows(spark):
    got = fingerprints.edited_documents(frame(spark, ODD)).collect()
    order = sorted(((r.doc_id, r.n_chars) for r in got), key=repr)
    assert order == sorted(((i, len(t or "")) for i, t in ODD), key=repr)
    empty = [r for r in got if r.doc_id in (1, 2)]
    assert {r.fingerprint for r in empty} == {"0" * 272} and {r.near_edited for r in empty} == {1.0}
    same = [r.fingerprint for r in got if r.doc_id == 4]
    assert same[0] == same[1]
    none = next(r for r in got if r.doc_id is None)  # null ids come first: the next is the smallest id
    text, then = ODD[0][1], "minus eight words here " * 10
    q = len(text) // 4
    assert none.edited_sha256 == hashlib.sha256((text[: len(text) - q] + then[:q]).encode()).hexdigest()
    assert fingerprints.edited_documents(frame(spark, [])).count() == 0
    alone = fingerprints.edited_documents(frame(spark, [(1, "abcdefgh")])).collect()
    assert [(r.edited_sha256, r.near_next) for r in alone] == [(hashlib.sha256(b"abcdefab").hexdigest(), 1.0)]


def test_likeness():
    """The estimate is near the true share of common spans, and tells edits from other texts."""
    r = random.Random(3)
    for n in (3, 12, 100, 3000, 50_000):
        text = "".join(r.choice("abcdefghij klmnop") for _ in range(n))
        edited = text[: n - n // 4] + "".join(r.choice("abcdefghij klmnop") for _ in range(n // 4))

        def spans(t):
            return {t[max(0, j - 8) : j] for j in range(1, len(t) + 1)}

        a, b = spans(text), spans(edited)
        true = 2 * len(a & b) / (len(a) + len(b))
        assert abs(fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(edited)) - true) < 0.15
        other = "".join(r.choice("qrstuvwxyz QRSTUVW") for _ in range(n))
        assert fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(other)) < 0.1
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint("a")) == 0


def test_spans_and_extensions():
    r = random.Random(4)
    texts = ["".join(r.choice("ab\x00") for _ in range(n)) for n in (0, 1, 9, 3000, 5000)]
    texts += [texts[3][:2500] + "c" + texts[3][2501:], texts[4][100:4000]]
    prefix = [fingerprints.prefixes(fingerprints.code_points(t)) for t in texts]
    for _ in range(400):
        (a, pa), (b, pb) = r.choice(list(zip(texts, prefix))), r.choice(list(zip(texts, prefix)))
        i, j = r.randint(0, len(a)), r.randint(0, len(b))
        if r.random() < 0.3:
            i = j = min(i, j)
        want = len(os.path.commonprefix([a[i:], b[j:]]))
        assert fingerprints.common_extension(pa, i, pb, j) == want
        n = r.randint(0, min(len(a) - i, len(b) - j))
        assert fingerprints.same_span(pa, i, pb, j, n) == (a[i : i + n] == b[j : j + n])
    for at in (0, 1, 700, 2047, 2048, 2049):
        t = texts[4]
        on = fingerprints.prefixes(fingerprints.code_points(t[at:]), fingerprints.prefixes(fingerprints.code_points(t[:at])))
        assert (on == prefix[4]).all()


def test_long_text():
    """A text of millions of code points, and an edit of it, are hashed as short ones are."""
    text = "ab c" * 800_000
    one, two = fingerprints._Read(1, text), fingerprints._Read(2, "z" * 10)
    row = one.edited(two)
    assert row[3] == fingerprints.fingerprint(text) and row[4] == fingerprints.fingerprint(text[:2_400_000] + "z" * 10)
    assert row[7:] == (2_400_000, 0)


def test_fingerprints_alone(spark):
    got = fingerprints.document_fingerprints(frame(spark, ODD)).collect()
    assert sorted(r.fingerprint for r in got) == sorted(fingerprints.fingerprint(t or "").hex() for _, t in ODD)


# --- whitening


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(0.5, 0.05, d)).astype(np.float32)


def check_whitened(got, rows, most=32):
    """Everything that the rows say, against a dense eigenvalue solver over whole numbers."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(0)
    y = n * x - sums
    z = (y / n).astype(float)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(most, int((values > 10 * len(values) * np.finfo(float).eps * values[0]).sum()))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    assert len(got) == n * m and set(by) == {i for i, _ in rows}
    for (i, _), deviation in zip(rows, (y * y).sum(1)):
        assert {r.deviation for r in by[i].values()} == {deviation}
    w = np.array([[by[i][k].whitened for k in range(1, m + 1)] for i, _ in rows])
    want = z @ axes[:, :m] / np.sqrt(values[:m])
    np.testing.assert_allclose(np.abs(w), np.abs(want), atol=1e-6)
    assert np.abs(np.abs((w * want).mean(0)) - 1).max() < 1e-9  # one sign for all rows


@pytest.mark.parametrize("n, d", [(700, 64), (40, 50), (300, 5), (900, 130)])
def test_whitening(spark, n, d):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(n, d))]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, x string").repartition(3)
    check_whitened(whitening.whitened(df).collect(), rows)


def test_whitening_on_a_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check_whitened(whitening.op12_whitening(spark, SMALL).collect(), rows)


def test_whitening_odd_rows(spark):
    good = [(i, v.tolist()) for i, v in enumerate(vectors(60, 6))]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, [1.0] * 3), (105, []), (106, [1e30] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, "x") for i, v in good + bad], "vec_id long, embedding array<float>, ids string")
    check_whitened(whitening.whitened(df).collect(), good)
    schema = "vec_id long, embedding array<double>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame(bad[:1], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0]), (None, [0.5, 2.0])], schema)).count() == 0
    twice = spark.createDataFrame([(1, [0.5, 2.0]), (1, [0.5, 2.0]), (None, [0.25, -2.0]), (2, [0.0, 0.0])], schema)
    got = whitening.whitened(twice).collect()
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 2 and {r.n for r in got} == {4}
    large = spark.createDataFrame([(1, [2.0**45]), (2, [-(2.0**45)]), (3, [0.0])], schema)
    assert {r.deviation for r in whitening.whitened(large).collect()} == {None, 0}


def test_products_are_added_in_stages(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(200, 8))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(9)
    check_whitened(whitening.whitened(df).collect(), rows)


@pytest.mark.parametrize("kind", ["flat", "steep", "clustered", "thin"])
def test_eigenpairs(kind):
    """Residuals come down to double precision, with few products of the matrix."""
    rng = np.random.default_rng(8)
    n, d = 3000, 160
    scale = {"flat": np.ones(d), "steep": np.exp(-np.arange(d) / 8), "clustered": np.repeat([3.0, 2.0, 1.0, 0.5], d // 4), "thin": np.r_[np.ones(5), np.zeros(d - 5)]}[kind]
    z = rng.normal(size=(n, d)) * scale
    z -= z.mean(0)
    calls = []

    def product(q):
        calls.append(q.shape[1])
        return z.T @ (z @ q) / n

    values, axes, norms = whitening.eigenpairs(product, d, 32)
    want = np.linalg.eigvalsh(z.T @ z / n)[::-1][:32]
    np.testing.assert_allclose(values, want, atol=1e-12 * want[0])
    assert np.abs(axes.T @ axes - np.eye(32)).max() < 1e-12
    assert np.linalg.norm(z.T @ (z @ axes) / n - axes * values, axis=0).max() < 1e-11 * want[0] and norms.max() < 1e-11 * want[0]
    assert len(calls) < 150
