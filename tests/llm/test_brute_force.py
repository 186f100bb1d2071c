"""Operators that SQL cannot express, or not on whole tables, against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from brightledger.llm import decontaminate, html_extract, near_stage, packing, simhash, substring_dedup, suffix_dedup, warc
from brightledger.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"


def corpus(n=60, seed=3):
    """Texts that share passages: copies, pieces, near copies, repeats within."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ka", "lo", "mi", "né")]
    base = [[r.choice(words) for _ in range(r.randint(60, 300))] for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(1, 4)):
            b = r.choice(base)
            at = r.randrange(len(b))
            parts += b[at : at + r.randint(5, 150)] if r.random() < 0.7 else [r.choice(words) for _ in range(r.randint(1, 90))]
        if r.random() < 0.2:
            parts = parts * 2
        out.append((r.randrange(10**6), r.choice(" \n") .join(parts)))
    return list(dict(out).items())


def brute_repeats(rows, split, join, window=50):
    first, out = {}, {}
    for i, t in sorted(rows):
        tokens = split(t)
        keys = [join(tokens[k : k + window]) for k in range(len(tokens) - window + 1)]
        covered = [False] * len(tokens)
        for k, key in enumerate(keys):
            if key in first:
                covered[k : k + window] = [True] * window
        for key in keys:
            first.setdefault(key, i)
        out[i] = covered
    return out


def test_repeated_bytes(spark):
    rows = corpus()
    want = brute_repeats(rows, str.encode, bytes)
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    texts = dict(rows)
    assert sum(map(sum, want.values())) > 1000
    for r in got:
        data, covered = texts[r.doc_id].encode(), want[r.doc_id]
        left = bytes(b for b, c in zip(data, covered) if not c)
        spans = len(re.findall(b"\x01+", bytes(covered)))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(data), sum(covered), spans, hashlib.sha256(left).hexdigest())


def test_repeated_words(spark):
    rows = corpus(seed=4)
    want = brute_repeats(rows, str.split, tuple)
    got = substring_dedup.repeated_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    texts = dict(rows)
    assert sum(map(sum, want.values())) > 500
    for r in got:
        kept = [w for w, c in zip(texts[r.doc_id].split(), want[r.doc_id]) if not c]
        assert (r.n_removed, r.kept_sha256) == (sum(want[r.doc_id]), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def test_hot_grams_are_witnessed(spark, monkeypatch):
    """The same results when almost every gram counts as one with very many phrases."""
    from brightledger.llm import repeats

    rows = corpus(seed=5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, suffix_dedup.repeated_bytes(df).collect()))
    run = repeats._dealt_anchors
    monkeypatch.setattr(repeats, "_dealt_anchors", lambda rule, *a: run(rule, *a, many=1))
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(df).collect())) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(b"ab\x00\xff"), min_size=1, max_size=120), st.integers(1, 60))
def test_suffix_order(data, length):
    from brightledger.llm.repeats import suffix_order

    starts = np.arange(max(0, len(data) - length + 1))
    order, new = suffix_order(np.array(data, np.uint8), starts, length)
    strings = [bytes(data[i : i + length]) for i in order]
    assert strings == sorted(strings) and sorted(order.tolist()) == starts.tolist()
    assert new.tolist() == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]


def test_small_runs_of_suffixes(spark, monkeypatch):
    from brightledger.llm import repeats

    df = spark.createDataFrame(corpus(seed=6), "doc_id long, text string")
    want = sorted(map(tuple, suffix_dedup.repeated_bytes(df).collect()))
    monkeypatch.setattr(repeats, "SORTED_BYTES", 300)
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(df).collect())) == want


def test_words_that_a_polynomial_confuses(spark):
    """Two words of 1,024 bytes, a Thue-Morse word and its complement, are not the same."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    other = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([one, *other])), (2, " ".join([two, *other])), (3, " ".join([one, *other]))]
    got = {r.doc_id: r.n_removed for r in substring_dedup.repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


def test_cover_is_a_difference_cover():
    differences = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert differences == set(range(substring_dedup.PERIOD))


def test_fingerprints_and_groups(spark):
    rows = [(i, t) for i, t in corpus(80)] + [(2_000_000, ""), (2_000_001, "one two"), (2_000_002, "ONE  two")]
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), radius=6).collect()}
    prints = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 6:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: (prints[i], find(i)) for i in prints}


def test_tiles_of_any_size_find_the_same(spark):
    fps = np.random.default_rng(1).integers(0, 2**12, 300).tolist()
    points = spark.createDataFrame([(i, f, 0) for i, f in enumerate(fps)], "node long, fp long, cell long")
    want = None
    for tile in (7, 64, 1000):
        links = simhash.tile_links(points, [0], 1, tile)
        got = sorted(map(tuple, connected_components(links).collect()))
        assert want in (None, got)
        want = got


def test_near_copies(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    sets = {r.doc_id: set(simhash.shingle_hashes(r.text, 5).tolist()) for r in rows}
    alike = {(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    got = {r.doc_id: r.component for r in near_stage.near_copies(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    assert alike and not {(a, b) for a, b in alike if got.get(a) is None or got.get(a) != got.get(b)}
    assert set(got) == {x for p in alike for x in p}


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


ALPHABET = st.sampled_from("a b c the\n")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=4), st.lists(st.sampled_from("abcd"), max_size=60))
def test_automaton(items, text):
    window = 3
    named = [(str(i), [w.encode() for w in words]) for i, words in enumerate(items)]
    spans, found = decontaminate.ItemAutomaton(named, window).matches([w.encode() for w in text])
    hit, want = set(), set()
    for i, words in enumerate(items):
        n = min(window, len(words))
        grams = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
        for k in range(len(text) - n + 1):
            if tuple(text[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                want.add(str(i))
    assert {k for a, b in spans for k in range(a, b)} == hit and found == want
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_blocks_of_items_agree(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(repr, decontaminate.contamination(docs, items).collect()))
    assert sorted(map(repr, decontaminate.contamination(docs, items, block_words=200).collect())) == want
    clean = {r.doc_id for r in decontaminate.uncontaminated(docs, items).select("doc_id").collect()}
    assert clean == {r.doc_id for r in decontaminate.contamination(docs, items).where("size(spans) = 0").collect()}


def test_word_ids_are_the_tokenizers_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    r = random.Random(5)
    texts = ["".join(r.choice("ab c  \n\t\r\x0b\x1c é'sx12!?　​") for _ in range(r.randint(0, 40))) for _ in range(500)]
    texts += ["", " ", "it's a test", "a 's b", "<|endoftext|> x", "x  y", "x \n y"]
    ids = packing.word_ids(*packing.default_vocabulary())
    for text, want in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert ids.of(text).tolist() == want.ids


@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_fills_bins(sizes):
    bins = packing.best_fit(np.array(sizes, np.int64), 64)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    fills = [sum(sizes[i] for i in b) for b in bins]
    assert all(f <= 64 for f in fills) and sum(f <= 32 for f in fills) <= 1


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = packing.token_pieces(docs, length=256, keep_ids=True)
    packed = packing.pack(pieces.drop("ids"), length=256, block=50).collect()
    ids = {(r.doc_id, r.piece): r.ids for r in pieces.collect()}
    assert len(packed) == len(ids)
    by = {}
    for r in packed:
        assert zlib.crc32(np.array(ids[r.doc_id, r.piece], "<u4").tobytes()) == r.ids_crc32 and len(ids[r.doc_id, r.piece]) == r.length
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= 1.1 * sum(len(x) for x in ids.values()) / 256 + 1


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_round_trip(version):
    records = [("http://a/b c", b"one\n\ntwo\r\n\r\n"), ("http://b/", b""), ("http://c/", "é".encode() * 50)]
    back = list(warc.parse_arc(warc.arc_block(version, records, "20240102030405")))
    assert [(r.header["url"], r.payload) for r in back] == records
    record = warc.warc_record(back[0], warc.record_id(7), None)
    (headers, block), = warc.parse_warc(__import__("io").BytesIO(record + b"\r\n\r\n"))
    assert headers["warc-type"] == "response" and headers["warc-date"] == "2024-01-02T03:04:05Z" and block.endswith(records[0][1])
    with pytest.raises(ValueError, match="truncated"):
        list(warc.parse_arc(warc.arc_block(version, records, "20240102030405")[:-20]))


@given(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.integers(0, 2**57 - 1))
def test_record_ids_carry_the_page(page, serial):
    assert warc.page_of(warc.record_id(page, serial)) == page
    assert warc.record_id(page, serial) != warc.record_id(page, serial ^ 1 << 56)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice">We use the cookies of this site</div>
<div id="main"><h2>The   title</h2><p>The first paragraph of the article is long enough to be running text, with the words that a reader of it knows.
<p>Short &amp; sweet.<p>And the last paragraph of the article, which is as long as the first and has as many of the words in it as any.</div>
<div class="sidebar"><p>The other stories of the day are in the list of this box, which is as long as a paragraph of the article is.</p></div>
<form><p>Your name</p><input></form><div class="comments"><p>I think that the article is the best of all the articles that there are on this site.</p></div>
<footer>&copy; us</footer></body></html>"""


def test_main_text():
    want = "The title The first paragraph of the article is long enough to be running text, with the words that a reader of it knows. Short & sweet. And the last paragraph of the article, which is as long as the first and has as many of the words in it as any."
    assert html_extract.main_text(PAGE) == want
    assert html_extract.main_text("<p>short") == "short" and html_extract.main_text(None) == ""
    assert html_extract.main_text("<ul><li><a href=y>x</a></ul>") == ""


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for r in html_extract.extract_pages(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        import html

        parts = [" ".join(html.unescape(re.sub("</?b>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert r.text == " ".join(p for p in parts if p)
