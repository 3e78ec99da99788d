"""Operator 9: what the bands may miss."""

import numpy as np

from larder.llm import icws


def missed(similarity):
    return (1 - similarity ** icws.ROWS) ** icws.BANDS


def test_pairs_at_the_limit_are_rarely_missed():
    assert missed(icws.SIMILARITY) < 3e-5


def test_bands_meet_as_often_as_stated():
    rng, pairs, met = np.random.default_rng(3), 400, 0
    draw = icws.sampler(icws.BANDS * icws.ROWS).draw
    for _ in range(pairs):
        own = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        a, b = (draw(s, np.ones(100)).reshape(icws.BANDS, icws.ROWS) for s in (own[:100], own[50:]))  # similarity 1/3
        met += (a == b).all(axis=1).any()
    assert abs(met / pairs - (1 - missed(1 / 3))) < 0.08
