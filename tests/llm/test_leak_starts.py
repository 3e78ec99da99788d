"""Operator 7: leaks whose best window starts at no alignment of a shared shingle."""

import random

from larder.llm import leak_simhash as ls
from test_leaks import brute


def found(text, item):
    index = ls.ItemIndex([(1, item)], ls.SHINGLE, ls.SIMILARITY, ls.RADIUS, ls.BLOCKS)
    return {(0, i): round(s, 9) for i, _, _, _, s in index.search(text)}


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(1, 12))) for _ in range(n)]


def test_exchanged_halves():
    rng = random.Random(4)
    item = words(rng, 120)
    text = " ".join(words(rng, 150) + item[60:] + item[:60] + words(rng, 150))
    assert brute([(0, text)], [(1, " ".join(item))])
    assert found(text, " ".join(item)) == brute([(0, text)], [(1, " ".join(item))])


def test_insertions_and_omissions_near_the_limit():
    rng, limit = random.Random(6), 0
    for _ in range(250):
        n = rng.randint(40, 130)
        item, m = words(rng, n), rng.randint(1, 1 + n // 9)
        at = rng.randint(0, n - m)
        leak = item[:at] + words(rng, m) + item[at:] if rng.random() < 0.5 else item[:at] + item[at + m:]
        text = " ".join(words(rng, 30) + leak + words(rng, 30))
        want = brute([(0, text)], [(1, " ".join(item))])
        limit += any(s < 0.83 for s in want.values())
        assert found(text, " ".join(item)) == want
    assert limit > 20
