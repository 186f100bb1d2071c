"""Windows of a sequence that also start in a sequence with a smaller id: the machinery of two operators.

An operator says how a text becomes 64-bit tokens and which positions of it are anchors: grams that any two
equal windows are bound to share at the same place within the window. Then, in five steps:

1. Anchors are hashed with all that their windows reach (the anchor's phrase). Within a task, a phrase that a
   smaller document of the task has too is settled on the spot; the rest is dealt by the anchor's hash.
2. Each part sorts its anchors. A phrase that a smaller document has settles all windows around the anchor; what
   is left of a gram with several phrases, one document for each phrase, needs its single windows compared.
3. Documents meet the settled and the needed positions. What is needed is dealt to the parts again: as the strings of
   the phrases, dealt by gram, where the rule works on bytes, and else as 128-bit hashes of windows.
4. Each part finds the smallest document of each window, which settles the others. Of strings it does so by a suffix
   array of its phrases, on their bytes (``suffix_order``).
5. Documents meet all settled positions and are written out.

What is dealt lies in packed arrays, a row for each task and part, so Spark moves few and large rows. The
numbers of parts and shards follow ``spark.sql.shuffle.partitions``, which is how a cluster is told the size
of its work. Copies are merged in each task before anything is dealt, and grams with very many phrases
are not dealt but only witnessed, so a task's share of a hot passage does not grow with its copies.

Phrases are told apart by 64-bit hashes among those of one gram (of whose hash 32 bits are kept): chance equals one out of some 2 ** 64 pairs
of different phrases with the same gram. A null id is larger than any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import shuffle_parts, stored, texts
from brightledger.llm.spans import Hashed, mixed

FLUSH_ANCHORS = 1_000_000
FLUSH_BYTES = 16_000_000
#: Texts of so many bytes are hashed at once (or a single longer one); a byte takes about 60 while it is.
SLICE_BYTES = 2_000_000
#: A gram with more phrases than this in one task is witnessed only, and all its windows are compared.
MANY_PHRASES = 32
NO_ID = np.iinfo(np.int64).max
WITNESS = np.uint32(2**32 - 1)

ANCHOR, SETTLED, NEEDED, WINDOW = 0, 1, 2, 3  # what a packed row holds
ROWS = "part int, shard int, kind int, columns binary"
KINDS = {"doc": np.int64, "version": np.uint32, "pos": np.uint32, "gram": np.uint32, "phrase": np.uint64, "check": np.uint64, "size": np.uint16}
#: Bytes of phrases whose suffixes are sorted at once (or those of one gram).
SORTED_BYTES = 1_000_000
TEXT_ROWS = "shard int, doc binary, size binary, packed binary"


@dataclass(frozen=True)
class Rule:
    """How texts become tokens, and where their anchors are."""

    window: int
    gram: int
    tokens: Callable  # (bytes, bounds) -> tokens, bounds
    anchors: Callable  # (Hashed, bounds) -> positions, gram hashes
    strings: bool = False  # tokens are bytes, and windows are compared as such


# --- packed rows: columns byte by byte, ids as differences, so that what repeats compresses


def _encoded(columns: dict[str, np.ndarray], at: np.ndarray) -> bytes:
    planes = []
    for name, values in columns.items():
        v = values[at].astype(KINDS[name])
        if name == "doc":
            v = np.diff(v, prepend=np.int64(0))  # wraps for far ids, and back when they are summed
        planes.append(np.ascontiguousarray(v.view(np.uint8).reshape(len(v), -1).T).tobytes())
    return len(at).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _decoded(data: bytes, names: list[str]) -> dict[str, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), np.uint8)
    out, at = {}, 0
    for name in names:
        width = np.dtype(KINDS[name]).itemsize
        out[name] = np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(KINDS[name]).reshape(n)
        at += n * width
    out["doc"] = np.cumsum(out["doc"])
    return out


def _cells(columns: dict[str, np.ndarray], order: np.ndarray, key: np.ndarray):
    """Slices of ``order`` with equal ``key`` (already in that order), as ``(key, packed columns)``."""
    if not len(order):
        return
    cuts = np.concatenate([[0], np.nonzero(np.diff(key))[0] + 1, [len(key)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(key[a]), _encoded(columns, order[a:b])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    part, shard, kind, columns = zip(*rows) if rows else ((),) * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip((part, shard, kind, columns), kinds)], ["part", "shard", "kind", "columns"])


def _shards_of(doc: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(doc.view(np.uint64)) % np.uint64(shards)).astype(np.int32)


PLACE = ["doc", "version", "pos"]


def _by_shard(kind: int, columns: dict[str, np.ndarray], shards: int, parts: int) -> list[tuple]:
    """Rows of positions for the documents' shards; they pass through part ``shard % parts``."""
    shard = _shards_of(columns["doc"], shards)
    order = np.lexsort((columns["pos"], columns["doc"], shard))
    return [(s % parts, s, kind, packed) for s, packed in _cells({k: columns[k] for k in PLACE}, order, shard[order])]


def _by_part(kind: int, columns: dict[str, np.ndarray], part: np.ndarray) -> list[tuple]:
    order = np.lexsort((columns["pos"], columns["doc"], part))
    return [(p, 0, kind, packed) for p, packed in _cells(columns, order, part[order])]


def _joined(table: pa.Table, kind: int, names: list[str]) -> dict[str, np.ndarray]:
    table = table.filter(pc.equal(table.column("kind"), kind))
    found = [_decoded(data, names) for data in table.column("columns").to_pylist()]
    return {n: np.concatenate([f[n] for f in found]) if found else np.zeros(0, KINDS[n]) for n in names}


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


# --- texts


def text_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, UTF-8 bytes end to end and their bounds, without a copy of the texts."""
    ids, text = batch.column(0), batch.column(1)
    wide = pa.types.is_large_string(text.type)
    _, at, data = text.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return ids.fill_null(NO_ID).to_numpy().astype(np.int64), data, at - at[0]


def _versions(data: np.ndarray, bounds: np.ndarray, unique: bool) -> np.ndarray:
    """Tells rows of one id apart; all alike where ids are unique."""
    if unique:
        return np.zeros(len(bounds) - 1, np.uint32)
    view = memoryview(np.ascontiguousarray(data))
    return np.array([zlib.crc32(view[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], np.uint32)


def packed_texts(docs: DataFrame, shards: int) -> DataFrame:
    """Texts by shard, many compressed together: what moves when documents meet their positions."""

    def run(batches):
        def flush():
            ids = np.concatenate(held_ids)
            order = np.argsort(_shards_of(ids, shards), kind="stable")
            shard = _shards_of(ids, shards)[order]
            cuts = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1, [len(shard)]])
            rows = []
            press = zstandard.ZstdCompressor(level=1)
            for a, b in zip(cuts[:-1], cuts[1:]):
                some = [held[i] for i in order[a:b]]
                size = np.array([~len(t) if nulls[i] else len(t) for i, t in zip(order[a:b], some)], np.int64).tobytes()
                rows.append((int(shard[a]), ids[order[a:b]].tobytes(), size, press.compress(b"".join(some))))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["shard", "doc", "size", "packed"])

        held_ids, held, nulls, n = [], [], [], 0
        for batch in batches:
            ids, data, bounds = text_arrays(batch)
            raw = data.tobytes()
            held_ids.append(ids)
            nulls += batch.column(0).is_null().to_pylist()
            held += [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            n += len(raw)
            if n >= FLUSH_BYTES:
                yield flush()
                held_ids, held, nulls, n = [], [], [], 0
        if held:
            yield flush()

    return docs.mapInArrow(run, TEXT_ROWS)


def _slices(ids: np.ndarray, data: np.ndarray, bounds: np.ndarray):
    """``(ids, bytes, bounds)`` of runs of texts, each of bounded size."""
    first = 0
    while first < len(ids):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE_BYTES, "right")) - 1)
        yield ids[first:last], data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def _unpacked(table: pa.Table):
    """``(ids, bytes, bounds, which ids are null)`` of each packed row; the size of a text without an id is its complement."""
    for doc, size, packed in zip(*(table.column(c).to_pylist() for c in ("doc", "size", "packed"))):
        data, size = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8), np.frombuffer(size, np.int64)
        yield np.frombuffer(doc, np.int64), data, np.concatenate([[0], np.cumsum(np.where(size < 0, ~size, size))]), size < 0


# --- step 1


def _dealt_anchors(rule: Rule, parts: int, shards: int, unique: bool, many: int = MANY_PHRASES):
    def flush(held):
        doc, version, pos, gram, phrase = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((doc, phrase, gram))
        doc, version, pos, gram, phrase = (c[order] for c in (doc, version, pos, gram, phrase))
        new_gram = _firsts(gram)
        new_phrase = new_gram | _firsts(phrase)
        least = doc[new_phrase][np.cumsum(new_phrase) - 1]
        settled = doc > least
        place = {"doc": doc, "version": version, "pos": pos}
        rows = _by_shard(SETTLED, {k: v[settled] for k, v in place.items()}, shards, parts)
        at = np.cumsum(new_gram) - 1
        hot = np.bincount(at[new_phrase], minlength=at[-1] + 1)[at] > many
        rows += _by_shard(NEEDED, {k: v[hot & ~settled] for k, v in place.items()}, shards, parts)
        witness = hot & new_gram
        sent = ~settled & ~hot | witness
        pos = np.where(witness, WITNESS, pos)
        part = (gram >> np.uint64(32)) % np.uint64(parts)
        columns = place | {"pos": pos, "gram": gram.astype(np.uint32), "phrase": phrase}
        rows += _by_part(ANCHOR, {k: v[sent] for k, v in columns.items()}, part[sent].astype(np.int32))
        return _batch(rows)

    def run(batches):
        held, n = [], 0
        for ids, data, text_bounds in (part for batch in batches for part in _slices(*text_arrays(batch))):
            versions = _versions(data, text_bounds, unique)
            tokens, bounds = rule.tokens(data, text_bounds)
            if not len(tokens):
                continue
            hashed = Hashed(tokens)
            pos, gram = rule.anchors(hashed, bounds)
            gram = mixed(gram)
            at = np.searchsorted(bounds, pos, "right") - 1
            begin = np.maximum(pos - (rule.window - rule.gram), bounds[at])
            end = np.minimum(pos + rule.window, bounds[at + 1])
            keep = end - begin >= rule.window
            pos, gram, at, begin, end = (c[keep] for c in (pos, gram, at, begin, end))
            phrase = mixed(hashed.of(begin, end) ^ mixed(((end - begin) * 4096 + (pos - begin)).astype(np.uint64)))
            held.append((ids[at], versions[at], (pos - bounds[at]).astype(np.uint32), gram, phrase))
            n += len(pos)
            if n >= FLUSH_ANCHORS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return run


# --- step 2


def _settled_phrases(parts: int, shards: int):
    def run(table: pa.Table) -> pa.Table:
        rows = []
        for kind in (SETTLED, NEEDED):
            passing = _joined(table, kind, PLACE)
            rows += _by_shard(kind, passing, shards, parts)
        a = _joined(table, ANCHOR, ["doc", "version", "pos", "gram", "phrase"])
        order = np.lexsort((a["doc"], a["phrase"], a["gram"]))
        a = {k: v[order] for k, v in a.items()}
        if len(order):
            doc, witness = a["doc"], a["pos"] == WITNESS
            new_gram = _firsts(a["gram"])
            new_phrase = new_gram | _firsts(a["phrase"])
            least = doc[new_phrase][np.cumsum(new_phrase) - 1]
            at = np.cumsum(new_gram) - 1
            begins = np.nonzero(new_gram)[0]
            # Several documents stand for phrases of the gram, or a task has seen very many of them.
            low, high = np.minimum.reduceat(least, begins), np.maximum.reduceat(least, begins)
            several = (low != high) | np.maximum.reduceat(witness, begins)
            settled = (doc > least) & ~witness
            needed = ~settled & several[at] & ~witness
            for kind, chosen in ((SETTLED, settled), (NEEDED, needed)):
                rows += _by_shard(kind, {k: a[k][chosen] for k in PLACE}, shards, parts)
        return pa.Table.from_batches([_batch(rows)])

    return run


# --- steps 3 and 4


class Places:
    """Positions of a shard, by document."""

    def __init__(self, table: pa.Table, kinds: tuple[int, ...]):
        found = {kind: _joined(table, kind, PLACE) for kind in kinds}
        self.found = {}
        for kind, c in found.items():
            order = np.lexsort((c["version"], c["doc"]))
            self.found[kind] = {k: v[order] for k, v in c.items()}
        self.known = set(np.concatenate([c["doc"] for c in found.values()]).tolist())

    def of(self, kind: int, doc: int, version: int) -> np.ndarray:
        c = self.found[kind]
        a, b = np.searchsorted(c["doc"], doc, "left"), np.searchsorted(c["doc"], doc, "right")
        lo, hi = np.searchsorted(c["version"][a:b], [version, version], "left")[0], np.searchsorted(c["version"][a:b], version, "right")
        return c["pos"][a + lo : a + hi].astype(np.int64)


def _starts(rule: Rule, anchors: np.ndarray, n: int) -> np.ndarray:
    """Which windows (by first token) hold one of the anchors."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.maximum(anchors - (rule.window - rule.gram), 0), 1)
    np.add.at(change, np.minimum(anchors, n - rule.window) + 1, -1)
    return np.cumsum(change[:n]) > 0


def _dealt_windows(rule: Rule, parts: int, shards: int, unique: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        places = Places(right, (SETTLED, NEEDED))
        held = []
        wanted = set(places.found[NEEDED]["doc"].tolist())
        for ids, data, text_bounds, _ in _unpacked(left):
            for i in range(len(ids)):
                if int(ids[i]) not in wanted:
                    continue
                text = data[text_bounds[i] : text_bounds[i + 1]]
                version = 0 if unique else zlib.crc32(text)
                need = places.of(NEEDED, ids[i], version)
                if not len(need):
                    continue
                tokens, _ = rule.tokens(text, np.array([0, len(text)]))
                n = len(tokens)
                open_ = _starts(rule, need, n) & ~_starts(rule, places.of(SETTLED, ids[i], version), n)
                at = np.nonzero(open_)[0]
                window, check = (mixed(Hashed(t).of(at, at + rule.window)) for t in (tokens, mixed(tokens)))
                held.append((np.full(len(at), ids[i]), np.full(len(at), version, np.uint32), at.astype(np.uint32), window, check))
        rows = []
        if held:
            doc, version, pos, window, check = (np.concatenate(c) for c in zip(*held))
            settled, order = _settled_windows(doc, window, check)
            place = {"doc": doc[order], "version": version[order], "pos": pos[order]}
            rows = _by_shard(WINDOW, {k: v[settled] for k, v in place.items()}, shards, parts)
            window, check = window[order], check[order]
            part = ((window >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
            rows += _by_part(ANCHOR, {k: v[~settled] for k, v in (place | {"phrase": window, "check": check}).items()}, part[~settled])
        return pa.Table.from_batches([_batch(rows)])

    return run


def _settled_windows(doc: np.ndarray, *window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows in their order: which start in a smaller document too; and the order."""
    order = np.lexsort((doc, *window[::-1]))
    doc = doc[order]
    new = _firsts(*(w[order] for w in window))
    return (doc > doc[new][np.cumsum(new) - 1] if len(doc) else np.zeros(0, bool)), order


def _least_windows(parts: int, shards: int):
    def run(table: pa.Table) -> pa.Table:
        rows = _by_shard(WINDOW, _joined(table, WINDOW, PLACE), shards, parts)
        w = _joined(table, ANCHOR, [*PLACE, "phrase", "check"])
        settled, order = _settled_windows(w["doc"], w["phrase"], w["check"])
        chosen = order[settled]
        rows += _by_shard(WINDOW, {k: w[k][chosen] for k in PLACE}, shards, parts)
        return pa.Table.from_batches([_batch(rows)])

    return run


# --- steps 3 and 4 on strings: a dictionary of phrases, its suffix array, and the parse that says where phrases stand

STRING = [*PLACE, "gram", "size"]


def _own_windows(anchors: np.ndarray, grams: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the windows in which each anchor's gram is the smallest, and the first of its kind."""
    low, high = anchors - reach, anchors.copy()
    k = 1
    while k < len(anchors) and (anchors[k:] - anchors[:-k]).min() <= reach:
        at = np.nonzero(grams[:-k] <= grams[k:])[0]
        low[at + k] = np.maximum(low[at + k], anchors[at] + 1)
        at = np.nonzero(grams[k:] < grams[:-k])[0]
        high[at] = np.minimum(high[at], anchors[at + k] - reach - 1)
        k += 1
    return low, high


def _dealt_strings(rule: Rule, parts: int, shards: int, unique: bool):
    """Needed phrases as bytes. A window belongs to its smallest anchor alone: equal windows have equal ones."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        places = Places(right, (SETTLED, NEEDED))
        wanted = set(places.found[NEEDED]["doc"].tolist())
        held, strings = [], []
        for ids, data, text_bounds, _ in _unpacked(left):
            for i in range(len(ids)):
                if int(ids[i]) not in wanted:
                    continue
                text = data[text_bounds[i] : text_bounds[i + 1]]
                version = 0 if unique else zlib.crc32(text)
                need = places.of(NEEDED, ids[i], version)
                if not len(need):
                    continue
                tokens, bounds = rule.tokens(text, np.array([0, len(text)]))
                n = len(tokens)
                anchors, grams = rule.anchors(Hashed(tokens), bounds)
                low, high = _own_windows(anchors, grams, rule.window - rule.gram)
                low, high = np.maximum(low, 0), np.minimum(high, n - rule.window)
                settled = np.concatenate([[0], np.cumsum(_starts(rule, places.of(SETTLED, ids[i], version), n))])
                keep = np.isin(anchors, need) & (low <= high)
                keep[keep] = settled[high[keep] + 1] - settled[low[keep]] < high[keep] + 1 - low[keep]
                low, size, grams = low[keep], (high - low)[keep] + rule.window, mixed(grams[keep])
                ends = np.cumsum(size)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)
                strings.append(text[at])
                held.append((np.full(len(low), ids[i]), np.full(len(low), version, np.uint32), low.astype(np.uint32), grams, size.astype(np.uint16)))
        rows = []
        if held:
            doc, version, pos, gram, size = (np.concatenate(c) for c in zip(*held))
            data, ends = np.concatenate(strings), np.cumsum(size.astype(np.int64))
            part = ((gram >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            columns = {"doc": doc, "version": version, "pos": pos, "gram": gram.astype(np.uint32), "size": size}
            cuts = np.concatenate([[0], np.nonzero(np.diff(part[order]))[0] + 1, [len(order)]])
            press = zstandard.ZstdCompressor(level=1)
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = order[a:b]
                if len(own):
                    of = size[own].astype(np.int64)
                    at = np.arange(of.sum()) + np.repeat(ends[own] - of - (np.cumsum(of) - of), of)
                    packed = _encoded(columns, own)
                    rows.append((int(part[own[0]]), 0, ANCHOR, len(packed).to_bytes(4, "little") + packed + press.compress(data[at].tobytes())))
        return pa.Table.from_batches([_batch(rows)])

    return run


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    rank = np.empty(len(keys), np.uint64)
    rank[order] = np.cumsum(_firsts(keys[order]))
    return rank, order


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``data`` as far as ``length`` bytes, at ``starts``: the order of these suffixes, and where
    in it a suffix has fewer than ``length`` bytes in common with the one before it.

    By prefix doubling: ranks of 8 bytes make those of 16, and so on; the last step overlaps.
    """
    n, have = len(data), min(8, length)
    padded = np.concatenate([data, np.zeros(have, np.uint8)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for j in range(have):
        keys = keys << np.uint64(8) | padded[j : j + n]
    while have < length:
        rank = np.concatenate([_ranks(keys)[0], np.zeros(length, np.uint64)])
        step = min(have, length - have)
        keys = rank[:n] << np.uint64(32) | rank[step : step + n]
        have += step
        if have == length:
            keys = keys[starts]
    if len(keys) != len(starts):
        keys = keys[starts]
    order = np.argsort(keys, kind="stable")
    return order, _firsts(keys[order])


def _least_strings(rule: Rule, parts: int, shards: int):
    def run(table: pa.Table) -> pa.Table:
        found, texts_ = [], []
        for packed in table.filter(pc.equal(table.column("kind"), ANCHOR)).column("columns").to_pylist():
            n = 4 + int.from_bytes(packed[:4], "little")
            found.append(_decoded(packed[4:n], STRING))
            texts_.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[n:]), np.uint8))
        rows = []
        if found:
            c = {name: np.concatenate([f[name] for f in found]) for name in STRING}
            data, size = np.concatenate(texts_), c["size"].astype(np.int64)
            at = np.cumsum(size) - size
            order = np.lexsort((c["doc"], c["gram"]))
            filled = np.cumsum(size[order])
            new = np.nonzero(_firsts(c["gram"][order]))[0]
            # Runs of whole grams of a bounded size.
            group = (filled[new] - size[order][new]) // SORTED_BYTES
            cuts = np.concatenate([new[_firsts(group)], [len(order)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                rows += _by_shard(WINDOW, _settled_strings(rule, data, {k: c[k][order[a:b]] for k in PLACE}, at[order[a:b]], size[order[a:b]]), shards, parts)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _settled_strings(rule: Rule, data: np.ndarray, place: dict, at: np.ndarray, size: np.ndarray) -> dict:
    """Positions of the dictionary's windows that a smaller document of the parse has too."""
    ends = np.cumsum(size)
    text = data[np.arange(ends[-1]) + np.repeat(at - (ends - size), size)]
    windows = size - rule.window + 1
    of = np.repeat(np.arange(len(size)), windows)
    shift = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    order, new = suffix_order(text, (ends - size)[of] + shift, rule.window)
    doc = place["doc"][of][order]
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc, np.nonzero(new)[0])
    settled = order[doc > least[group]]
    return {"doc": place["doc"][of[settled]], "version": place["version"][of[settled]], "pos": (place["pos"][of[settled]] + shift[settled]).astype(np.uint32)}


# --- step 5


def _written(rule: Rule, unique: bool, names: list[str], kinds: list, finish: Callable):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        places = Places(right, (SETTLED, WINDOW))
        ids_out, out = [], []
        for ids, data, bounds, nulls in _unpacked(left):
            for i in range(len(ids)):
                text = data[bounds[i] : bounds[i + 1]]
                covered = None
                if int(ids[i]) in places.known:
                    version = 0 if unique else zlib.crc32(text)
                    phrases, windows = places.of(SETTLED, ids[i], version), places.of(WINDOW, ids[i], version)
                    if len(phrases) or len(windows):
                        n = len(rule.tokens(text, np.array([0, len(text)]))[0])
                        starts = _starts(rule, phrases, n)
                        starts[windows] = True
                        change = np.zeros(n + 1, np.int32)
                        at = np.nonzero(starts)[0]
                        change[at] += 1
                        np.add.at(change, at + rule.window, -1)
                        covered = np.cumsum(change[:n]) > 0
                ids_out.append(None if nulls[i] else int(ids[i]))
                out.append(finish(text.tobytes(), covered))
        columns = [pa.array(ids_out, pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(kinds), kinds))]
        return pa.table(columns, ["doc_id", *names])

    return run


def without_repeats(docs: DataFrame, rule: Rule, schema: str, names: list[str], kinds: list, finish: Callable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for every input row: ``doc_id`` and what ``finish(text, covered)`` returns.

    ``covered`` tells for each token whether a window that a smaller document has too holds it; None: none.
    """
    spark = docs.sparkSession
    parts = shards = shuffle_parts(spark)
    rows = texts(docs, id_col, text_col)
    unique = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty()

    def dealt() -> DataFrame:
        anchors = rows.mapInArrow(_dealt_anchors(rule, parts, shards, unique), ROWS)
        return stored(anchors.groupBy("part").applyInArrow(_settled_phrases(parts, shards), ROWS))

    def compared(phrases: DataFrame) -> DataFrame:
        deal = _dealt_strings if rule.strings else _dealt_windows
        least = _least_strings(rule, parts, shards) if rule.strings else _least_windows(parts, shards)
        sides = packed_texts(rows, shards).groupBy("shard"), phrases.groupBy("shard")
        windows = sides[0].cogroup(sides[1]).applyInArrow(deal(rule, parts, shards, unique), ROWS)
        return stored(windows.groupBy("part").applyInArrow(least, ROWS))

    phrases = dealt()
    settled = phrases.where(f"kind = {SETTLED}").unionByName(compared(phrases))
    sides = packed_texts(rows, shards).groupBy("shard"), settled.groupBy("shard")
    return sides[0].cogroup(sides[1]).applyInArrow(_written(rule, unique, names, kinds, finish), schema)
