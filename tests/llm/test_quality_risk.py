"""The quality classifier's risk and prior against plain evaluations."""

import math

import numpy as np

from brightledger.llm import quality


def plain_risk(zp, zu, prior):
    """The non-negative unbiased risk by its definition, score by score."""
    loss = lambda z, y: math.log1p(math.exp(-y * z))
    positive = sum(loss(z, 1) for z in zp) / len(zp)
    negative = sum(loss(z, -1) for z in zu) / len(zu) - prior * sum(loss(z, -1) for z in zp) / len(zp)
    return prior * positive + max(0.0, negative)


def mixture(n, prior, seed):
    r = np.random.default_rng(seed)
    width = quality.FIGURES * 3 + quality.WORD_BINS + quality.BYTE_BINS
    good = r.normal(0.8, 1, (n, width)).astype(np.float32)
    bad = r.normal(-0.8, 1, (n, width)).astype(np.float32)
    k = int(prior * n)
    return good[:300], np.vstack([good[300 : 300 + k], bad[: n - k]]), np.arange(n) < k


def test_risk_by_definition():
    r = np.random.default_rng(1)
    for prior in (0.1, 0.5, 0.9):
        zp, zu = r.normal(1, 2, 50), r.normal(0, 2, 80)
        assert math.isclose(quality.risk(zp, zu, prior), plain_risk(zp, zu, prior), rel_tol=1e-9)


def test_fit_lowers_the_risk_and_finds_the_prior():
    for prior in (0.3, 0.7):
        positive, unlabelled, good = mixture(1200, prior, 2)
        model = quality.fit(positive, unlabelled)
        assert abs(model["prior"] - prior) < 0.05
        zp, zu = quality.raw(model, positive), quality.raw(model, unlabelled)
        assert plain_risk(zp, zu, prior) < 0.2 * plain_risk(zp * 0, zu * 0, prior)
        assert ((zu > 0) == good).mean() > 0.97


def test_prior_of_mixed_scores():
    r = np.random.default_rng(3)
    positive, negative = r.normal(2, 1, 4000), r.normal(-2, 1, 4000)
    for prior in (0.2, 0.6, 0.9):
        k = int(prior * 4000)
        found = quality.class_prior(positive, np.concatenate([r.normal(2, 1, k), negative[: 4000 - k]]))
        assert abs(found - prior) < 0.06
