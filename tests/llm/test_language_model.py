"""Operator 5: base against brute force, probabilities, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import log_bilinear as lb


def brute(rows):
    """(n_tokens, n_known, N, base) of every row."""
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]
    count = Counter()
    for doc, text in rows:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 10:
            count.update(cut(text))
    n, v = sum(count.values()), len(count)
    return [(len(c := cut(t)), sum(w in count for w in c), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in c))
            for _, t in rows]


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    tongues = [[a + b for a in "bdfg" for b in "aeiou"], [a + b for a in "klmn" for b in "àéîõü"]]
    out = []
    for i in range(n):
        words = [rng.choice(rng.choice([tongues[i % 2]])) for _ in range(rng.randint(0, 120))]
        words += ["".join(rng.choice(tongues[i % 2]) for _ in range(4)) for _ in range(rng.randint(0, 6))]  # rare
        out.append((i, " ".join(w.title() if rng.random() < 0.2 else w for w in words)))
    return out + [(n, None), (n + 1, ""), (n + 2, " \t\x0b\n"), (n + 3, "\x1c\x85\xa0 x"), (None, "ba be"), (3, "again"), (n + 4, "Ä" * 50_000)]


@pytest.mark.parametrize("head", [400_000, 8])
def test_counts_base_and_held_out_gain(spark, monkeypatch, head):
    monkeypatch.setattr(lb, "HEAD", head)  # a small table sends nearly all tokens through the join
    monkeypatch.setattr(lb, "LEAST_TOKENS", 200_000)
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, token string")
    got = lb.score_texts(df.repartition(3)).collect()
    want = sorted(((d, *b) for (d, _), b in zip(rows, brute(rows), strict=True)), key=lambda r: (str(r[0]), r[1]))
    mine = sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens))
    for r, w in zip(mine, want, strict=True):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9)
    out = [r for r in got if r.held_out]
    assert len(out) > 10 and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_add_up_to_one(spark, monkeypatch):
    monkeypatch.setattr(lb, "LEAST_TOKENS", 50_000)
    monkeypatch.setattr(lb, "WORDS", 20)
    rows = [(d, t) for d, t in corpus(80) if t and d is not None]
    vocabulary, parameters, tail = lb.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    scorer = lb.Scorer(vocabulary, parameters)
    every = np.arange(vocabulary.units)
    tokens = vocabulary.tokens + [bytes(r.token) for r in tail.collect()]
    assert len(tokens) == vocabulary.distinct
    for two, one in [(0, 0), (3, 5), (vocabulary.units - 1, 7)]:
        p = scorer.log10(np.full(len(every), two), np.full(len(every), one), every)
        assert (10 ** p).sum() == pytest.approx(1, abs=1e-4)
        # Every token, and in each class what no text has.
        at, unit = vocabulary.units_of(tokens, {})
        inside = np.where(at >= 0, vocabulary.inside[at], 0) - vocabulary.class_log[unit]
        unknown = (10 ** (p[vocabulary.words:] + np.log10(0.1) - vocabulary.class_log[vocabulary.words:])).sum()
        assert (10 ** (p[unit] + inside)).sum() + unknown == pytest.approx(1, abs=1e-3)


def test_empty_and_untrainable_tables(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lb.score_texts(df.limit(0)).count() == 0
    held = next(n for n in range(100) if zlib.crc32(str(n).encode()) % 10 == 0)
    row = lb.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert np.isfinite(row.score)
