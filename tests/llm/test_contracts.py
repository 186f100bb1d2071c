"""Whole queries by hand: the columns and the radius of op3, ties and repeated rows of op6 and op8, spans that are removed."""

import random
import re

import xxhash

from brightledger.llm import decontaminate, packing, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def near_texts(n=60, seed=4):
    """Long texts, many of them with a word or two replaced, some of no words, some that repeat."""
    r = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "abcdef" for b in ("ka", "Lo", "mé") for c in ("x", "yy")]
    base = [[r.choice(words) for _ in range(400)] for _ in range(5)]
    rows = []
    for i in range(n):
        text = list(r.choice(base))
        for _ in range(r.randrange(3)):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((r.randrange(10**6), r.choice([" ", "\n", "  "]).join(text)))
    return list(dict(rows).items()) + [(-1, ""), (-2, None), (-3, " \t"), (-4, "One"), (-5, "one"), (10**7, rows[0][1])]


def test_simhash_query(spark, tmp_path):
    rows = near_texts()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.queries()["op3_simhash"](spark, str(tmp_path)).collect()}
    prints = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    group = {i: i for i in prints}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert any(prints[a] != prints[b] for a, b in linked)  # links that are no copies
    for _ in prints:
        for a, b in linked:
            group[a] = group[b] = min(group[a], group[b])
    assert got == {i: (f"{prints[i]:016x}", group[i]) for i in prints}


def test_spans_are_removed(spark):
    r = random.Random(6)
    pool = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choice(pool) for _ in range(n))) for i, n in enumerate((30, 12, 10, 10, 4))] + [(90, None), (91, "")]
    rows = []
    for i in range(40):
        parts = [" ".join(r.choice(pool) for _ in range(r.randrange(1, 25))) for _ in range(3)]
        item = (r.choice(items[:5])[1]).split()
        cut = item[r.randrange(3) :]
        parts.insert(r.randrange(4), ", ".join(cut).upper())
        rows.append((i, r.choice([" ", ".\n"]).join(parts)))
    rows += [(100, None), (101, ""), (102, items[1][1]), (None, "plain text"), (103, items[1][1] + " tail"), (103, items[1][1] + " tail")]
    windows = set()
    for _, text in items:
        words = [w.lower() for w in WORD.findall(text or "")]
        n = min(10, len(words))
        windows |= {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()

    def brute(text, least, share):
        text = text or ""
        found = list(WORD.finditer("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)))
        words = [m[0] for m in found]
        hit = [False] * len(words)
        for w in windows:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit[k : k + len(w)] = [True] * len(w)
        if sum(hit) > share * len(words):
            return None
        spans, k = [], 0
        while k < len(hit):
            e = k
            while e < len(hit) and hit[e]:
                e += 1
            if e - k >= least:
                spans.append((found[k].start(), found[e - 1].end()))
            k = max(e, k + 1)
        if not spans:
            return text
        edges = [0, *(x for s in spans for x in s), len(text)]
        parts = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
        parts = [p.rstrip() if i < len(parts) - 1 else p.lstrip() for i, p in enumerate(parts)]
        return " ".join(p for p in parts if p)

    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, spans int, words string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    removed = 0
    for least, share in ((10, 0.5), (4, 0.8), (12, 1.0)):
        got = sorted(((r.doc_id, r.text) for r in decontaminate.without_spans(docs, frame, least, share, block_words=25).collect()), key=repr)
        want = sorted(((i, brute(t, least, share)) for i, t in rows if brute(t, least, share) is not None), key=repr)
        assert got == want
        removed += sum(t != (dict(rows)[i] or "") for i, t in got if i is not None)
    assert removed > 20


def test_decontamination_of_repeated_rows(spark):
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(1, f"a {item} b"), (1, f"a {item} b"), (1, "clean"), (None, item), (2, "")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_words int")
    got = decontaminate.contamination(docs, spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, len(r.spans)) for r in got), key=repr) == sorted([(1, 14, 1), (1, 14, 1), (1, 1, 0), (None, 12, 1), (2, 0, 0)], key=repr)


def test_packing_of_repeated_rows_and_long_texts(spark):
    long = "token " * 9000
    rows = [(1, long), (1, long), (2, None), (2, ""), (None, "x"), (3, "a b"), (3, "a b")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, piece int")
    got = packing.packed_documents(docs).collect()
    of = {}
    for r in got:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in of.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(of) == -(-total // 2048)  # as few as there can be
    pieces = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 1)
    assert len(pieces) == 2 * len(set(pieces)) and sum(r.length for r in got if r.doc_id == 1) == 2 * (sum(n for _, _, n, _ in set(pieces)))
    assert sorted(r.length for r in got if r.doc_id == 2) == [1, 1] and sum(r.doc_id is None for r in got) == 1
