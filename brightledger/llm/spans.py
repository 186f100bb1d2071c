"""Numpy steps over many token sequences at once, for the operators that look for repeated windows.

The sequences of a batch lie end to end in one array of 64-bit tokens; ``bounds`` holds where each begins and
the last ends. Hashes are polynomial, modulo 2 ** 64, from prefix sums, so the hash of any stretch costs a
subtraction and a product, wherever it lies.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Words of more bytes are hashed by XXH64: a polynomial modulo a power of two gives some longer strings equal hashes whatever its base.
LONG_WORD = 64
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)  # odd, and 5 modulo 8: powers repeat as late as they can
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of hashes (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Hashes of stretches of a token array."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        powers = np.full(n + 1, BASE)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * powers[:n], out=self.sums[1:])
        powers[:] = INVERSE
        powers[0] = 1
        self.back = np.multiply.accumulate(powers, out=powers)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


#: A random 64-bit number for each byte, from a fixed seed.
BYTE_TOKENS = np.random.default_rng(20240229).integers(0, 2**64, 256, np.uint64, endpoint=False) | np.uint64(1)


def word_tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of UTF-8 texts: their 64-bit tokens, bounds by text, and byte starts and ends."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(white[1:], white[:-1], out=edge[1:-1])
    edge[bounds] = True
    at = np.nonzero(edge)[0]
    starts, ends = at[:-1], at[1:]
    words = ~white[starts] if len(data) else np.zeros(0, bool)
    starts, ends = starts[words], ends[words]
    tokens = mixed(Hashed(BYTE_TOKENS[data]).of(starts, ends) + (ends - starts).astype(np.uint64))
    long = np.nonzero(ends - starts > LONG_WORD)[0]
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        tokens[long] = [xxhash.xxh64_intdigest(view[starts[i] : ends[i]]) for i in long.tolist()]
    return tokens, np.searchsorted(starts, bounds), starts, ends


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``size`` words; fewer words are one shingle, none are none."""
    tokens, at, _, _ = word_tokens(data, bounds)
    weights = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(tokens) - size + 1
    every = mixed(sum(tokens[j : j + n] * weights[j] for j in range(size))) if n > 0 else np.zeros(0, np.uint64)
    found = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            own = np.sort(every[a : b - size + 1])
            found.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            own = tokens[a:b] * weights[: b - a]
            found.append(mixed(np.array([own.sum(dtype=np.uint64) + np.uint64(b - a)])) if b > a else own)
    return found


def sliding(x: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over each ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        more = min(have, width - have)
        x = take(x[:-more], x[more:])
        have += more
    return x


def local_minima(h: np.ndarray, bounds: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Positions whose gram has the smallest hash in some window of the same sequence, ties included.

    Two equal windows choose the same grams, wherever they lie. ``h`` is the hash of the gram at each position.
    """
    width = window - gram + 1  # grams of a window
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = sliding(h, width, np.minimum)
    n_tokens = bounds[-1]
    inside = np.zeros(n_tokens + 1, np.int8)
    lengths = np.diff(bounds)
    fits = lengths >= window
    inside[bounds[:-1][fits]] += 1
    inside[bounds[1:][fits] - window + 1] -= 1
    least[np.cumsum(inside[: len(least)]) == 0] = 0
    padded = np.concatenate([np.zeros(width - 1, h.dtype), least, np.zeros(width - 1, h.dtype)])
    return np.nonzero(sliding(padded, width, np.maximum) == h)[0]


def stretches(flags: np.ndarray) -> np.ndarray:
    """``(start, end)`` of the runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.column_stack([np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]])
