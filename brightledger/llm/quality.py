"""Quality classifier by positive-unlabelled learning.

Trusted positives (rows labelled good) and unlabelled web text train a logistic model over figures of the text's form and
over its content: hashed words and hashed triples of bytes, as shares of the text. The risk is the non-negative unbiased
one (Kiryo et al. 2017): the unlabelled risk less the positives' part of it may not fall below zero. Its class prior
is estimated from positives and unlabelled text alone: no set of texts can hold a smaller share of the unlabelled texts than
the prior times its share of the positives, so the least such ratio over the sets above a score bounds the prior from above,
and reaches it where some set is almost pure. Bad labels are never used.

The model is fitted on at most ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` rows, chosen by a hash of the doc_id, which is a
documented bound of the fit alone; every whole text is scored.

Defined cases: null and empty texts have figures of their own and get a score; without any positives every
score is 0.5; a doc_id labelled twice counts with its lower label; repeated rows score alike; null doc_ids are scored and never
learnt from; texts may be of any length; other columns, whatever their names, are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, slices, texts
from brightledger.llm.html_extract import STOP_WORDS
from brightledger.llm.spans import word_tokens

MOST_POSITIVE = 10_000
MOST_UNLABELLED = 30_000
STOP_BYTES = frozenset(w.encode() for w in STOP_WORDS)
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".,;:'\"-()?"]] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[b for b in range(33, 127) if not (chr(b).isalnum() or STOPS[b])]] = True
FIGURES, WORD_BINS, BYTE_BINS = 14, 64, 64
#: How strongly weights are held to zero: those of the figures hardly, those of the many content features more.
DECAY, CONTENT_DECAY = 1e-4, 3e-2
#: Part of the positives that a set of the prior's estimate must hold: small sets' shares are noise.
LEAST_SHARE = 0.3


def figures(text: str | None) -> list[float]:
    """Figures of a text's form: lengths, character classes, repetition, running words."""
    data = (text or "").encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(1, len(data))
    letters = counts[LETTERS].sum()
    words = data.split()
    m = max(1, len(words))
    upper = counts[UPPER].sum()
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    distinct = len(set(words))
    bare = [w.lower().strip(b".,;:!?") for w in words]
    odd = sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in (b".", b",", b"?", b":", b";", b")"))
    lines = data.count(b"\n") + 1
    return [
        np.log1p(len(words)),
        upper / max(1, letters),
        counts[DIGITS].sum() / n,
        counts[SYMBOLS].sum() / n,
        counts[STOPS].sum() / n,
        letters / n,
        sum(map(len, words)) / m / 10,
        repeats / m,
        distinct / m**0.8,
        sum(w in STOP_BYTES for w in bare) / m,
        odd / m,
        sum(not LETTERS[w[0]] for w in words) / m if words else 1.0,
        np.log1p(m / lines),
        float(not words),
    ]


def content(text: str | None) -> np.ndarray:
    """Hashed words and hashed triples of bytes, as square roots of their shares of the text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    tokens = word_tokens(data, np.array([0, len(data)]))[0]
    words = np.bincount((tokens >> np.uint64(58)).astype(np.int64), minlength=WORD_BINS)
    wide = data.astype(np.uint32)
    triples = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77) ^ wide[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    parts = np.bincount((triples >> np.uint32(26)).astype(np.int64), minlength=BYTE_BINS)
    return np.concatenate([np.sqrt(words / max(1, words.sum())), np.sqrt(parts / max(1, parts.sum()))])


def features(text: str | None) -> np.ndarray:
    return np.concatenate([figures(text), content(text)]).astype(np.float32)


def expanded(x: np.ndarray) -> np.ndarray:
    """All features, with squares and capped values of the figures: bends that a linear model needs."""
    form = x[:, :FIGURES]
    return np.hstack([x, form**2, np.minimum(form, 0.05) * 20]).astype(np.float32)


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """The non-negative risk of positives' and unlabelled texts' raw scores, by the logistic loss."""
    as_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    return float(prior * np.logaddexp(0, -zp).mean() + max(0.0, as_negative))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = LEAST_SHARE) -> float:
    """The share of positives in the unlabelled texts, from scores of texts that the scoring model has not seen."""
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 50))
    above = [((unlabelled >= c).mean(), (positive >= c).mean()) for c in cuts]
    return float(np.clip(min(u / p for u, p in above if p > 0), 0.01, 0.99))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05) -> dict:
    """Weights of the logistic model that minimises the non-negative risk; a plain numpy fit by Adam."""
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    one = np.float32(1)
    p = np.hstack([np.clip((positive - mean) / scale, -8, 8), np.full((len(positive), 1), one)])
    u = np.hstack([np.clip((unlabelled - mean) / scale, -8, 8), np.full((len(unlabelled), 1), one)])
    w = np.zeros(p.shape[1], np.float32)
    decay = np.full_like(w, DECAY)
    decay[FIGURES : FIGURES + WORD_BINS + BYTE_BINS] = CONTENT_DECAY
    first, second = np.zeros_like(w), np.zeros_like(w)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        as_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        pull = -prior * (sigmoid(-zp) @ p) / len(p)
        push = (sigmoid(zu) @ u) / len(u) - prior * (sigmoid(zp) @ p) / len(p)
        gradient = (pull + push if as_negative >= 0 else -push) + decay * w
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        step = rate * (0.5 * (1 + np.cos(np.pi * t / steps)) + 0.01)
        w = w - step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return {"mean": mean, "scale": scale, "w": w}


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> dict:
    """The model of the estimated prior: halves score each other for the estimate, then all rows are fitted."""
    halves = [(positive[i::2], unlabelled[i::2]) for i in (0, 1)]
    seen = [[], []]
    if min(len(x) for half in halves for x in half) >= 20:
        for (p, u), other in zip(halves, reversed(halves)):
            model = fit_nnpu(p, u, 0.5, steps=200)
            for k in (0, 1):
                seen[k].append(raw(model, other[k]))
        prior = class_prior(*(np.concatenate(s) for s in seen))
    else:
        prior = 0.5
    return {"prior": prior} | fit_nnpu(positive, unlabelled, prior)


def raw(model: dict, x: np.ndarray) -> np.ndarray:
    return np.clip((x - model["mean"]) / model["scale"], -8, 8) @ model["w"][:-1] + model["w"][-1]


def score(model: dict, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw(model, expanded(x)).astype(float), -30, 30)))


def feature_rows(docs: DataFrame) -> DataFrame:
    """``(x)`` of ``(doc_id, text)``: the features as packed 32-bit floats."""

    def run(batches):
        for batch in slices(batches):
            yield pa.record_batch([pa.array([features(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], ["x"])

    return docs.select("doc_id", "text").mapInArrow(run, "x binary")


def learnable(id_col: str = "doc_id"):
    """Whether a row's label may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The model; ``docs`` has ``doc_id, text``, ``labels`` ``doc_id, quality``."""
    known = labels.where(learnable() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = known.where("quality = 1").select("doc_id")
    n_good = good.count()
    if not n_good:
        return {"prior": 0.5}

    def chosen(df: DataFrame, n: int, most: int, salt: int) -> DataFrame:
        # A part of all hashes in 62 bits, so that the smallest of shares still chooses rows.
        share = min(1.0, 0.9 * most / max(1, n))
        return df.where(F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(2**62)) < int(share * 2**62))

    some = chosen(good, n_good, MOST_POSITIVE, 1)
    positive = docs.join(F.broadcast(some), "doc_id", "left_semi")  # at most so many ids
    unlabelled = chosen(docs.where("doc_id is not null"), docs.count(), MOST_UNLABELLED, 2)
    width = FIGURES + WORD_BINS + BYTE_BINS
    # The bound comes after the features: texts stay where they are.
    rows = [feature_rows(df).limit(most).collect() for df, most in ((positive, MOST_POSITIVE), (unlabelled, MOST_UNLABELLED))]
    xs = [np.frombuffer(b"".join(r.x for r in some), np.float32).reshape(-1, width) for some in rows]
    if not (len(xs[0]) and len(xs[1])):
        return {"prior": 0.5}
    return fit(expanded(xs[0]), expanded(xs[1]))


def scored(docs: DataFrame, model: dict, keep: list[str], text_col: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the score of its ``text_col``, as ``out``."""
    at = keep.index(text_col) if text_col in keep else len(keep)
    rows = docs.select(*keep) if at < len(keep) else docs.select(*keep, text_col)

    def run(batches):
        for batch in slices(batches):
            x = np.array([features(t.as_py()) for t in batch.column(at)], np.float32).reshape(batch.num_rows, -1)
            s = score(model, x) if "w" in model else np.full(len(x), model["prior"])
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(s, pa.float64())], [*keep, out])

    return rows.mapInArrow(run, docs.select(*keep, F.lit(0.0).alias(out)).schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row."""
    rows = texts(docs, id_col, text_col)
    return scored(rows, train(rows, labels), ["doc_id"])


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    # A row without a doc_id has no such remainder.
    return found.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
