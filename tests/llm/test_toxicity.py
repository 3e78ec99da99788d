"""Operator 4: the kernel against its definition, and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pytest

from larder.llm import toxic_kernel as tk


def slow_kernel(a, b):
    """All subsequences of three characters with their gaps."""
    def vector(s):
        codes = [c for c in (int(tk.CODES[min(ord(x), 0xFFFF)]) for x in s) if c]
        out, norm = {}, 0.0
        for i, j, k in itertools.combinations(range(len(codes)), 3):
            if k - i < tk.SPAN:
                w = tk.DECAY ** (k - i - 2)
                out[codes[i], codes[j], codes[k]] = out.get((codes[i], codes[j], codes[k]), 0) + w
                norm += w * w
        return {u: w / norm ** 0.5 for u, w in out.items()}
    x, y = vector(a), vector(b)
    return sum(w * y.get(u, 0) for u, w in x.items())


@pytest.mark.parametrize("pair", [("idiot", "idiot"), ("idiot", "id-i*ot"), ("moron", "mo0ron"), ("ab", "abc"), ("", "abc"),
                                  ("größe", "grosse"), ("abcabcabc", "bca"), ("日本語だ", "日本語"), ("x" * 24, "xx")])
def test_kernel_is_its_definition(pair):
    assert tk.kernel(*pair) == pytest.approx(slow_kernel(*pair), abs=1e-5)


def test_folded_scores_are_kernel_sums():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé1-") for _ in range(rng.randint(1, 24))) for _ in range(80)]
    marks, gamma = words[:9], np.linspace(-1, 1, 9)
    folded = tk.Landmarks(marks).folded(gamma)
    want = [sum(g * tk.kernel(w, m) for g, m in zip(gamma, marks, strict=True)) for w in words]
    assert np.allclose(tk.folded_scores(words, folded), want, atol=1e-4)


def texts(n, seed, spoil=lambda w: w):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es", "or"]) for _ in range(rng.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), spoil(rng.choice(["blockhead", "dimwit", "scumbag", "vermin"])))
        out.append((i, " ".join(words) + ".", int(toxic)))
    return out


def spaced(word):
    return " ".join(word)


def starred(word):
    return word[:3] + "*" + word[3:] + "!"


def inserted(word):
    return word[:4] + "x" + word[4:]


@pytest.mark.parametrize("spoil", [lambda w: w, spaced, starred, inserted])
def test_held_out_texts(spoil):
    train, test = texts(500, 1), texts(200, 2, spoil)
    machine = tk.train([t for _, t, _ in train], [y for *_, y in train])
    score = tk.text_margins(machine, [t for _, t, _ in test])
    y = np.array([y for *_, y in test])
    order = np.argsort(np.argsort(score)) + 1
    auc = (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc > (0.95 if spoil is inserted else 0.99)


def test_query_shape_and_what_is_learnt(spark):
    rows = texts(400, 3)
    docs = [(i, t, "score") for i, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (1002, "a" * 300_000, "x"), (None, "no id", "x"), (1, rows[1][1], "x")]
    out_fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    df = spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3)
    labels = [(i, 0, y) for i, _, y in rows] + [(None, 0, 1), (5000, 0, 1), (2, 0, None), (rows[0][0], 0, rows[0][2])]
    flipped = [(i, q, None if y is None else 1 - y) if out_fold(i) else (i, q, y) for i, q, y in labels]
    got = [sorted(tk.toxicity(df, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect(), key=str)
           for x in (labels, flipped)]
    assert got[0] == got[1]  # held-out labels change nothing
    assert len(got[0]) == len(docs)
    score = {}
    for r in got[0]:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == out_fold(r.doc_id)
        score.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(v) == 1 for v in score.values())
    assert score[1000] == score[1001] and max(score[1000]) < 0.5
    right = [(max(score[i]) >= 0.5) == bool(y) for i, _, y in rows if out_fold(i)]
    assert np.mean(right) > 0.95
    kept = tk.without_toxic(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.schema == df.schema
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got[0] if not r.predicted)


def test_without_labels_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in tk.toxicity(df, none).collect()] == [0, 0]
    assert tk.toxicity(df.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert tk.toxicity(df, one).count() == 2


def test_windows_of_a_sentence():
    words, joined = tk.windows("you mo ron, s c u m. it")
    assert words[:8] == ["you", "mo", "ron,", "s", "c", "u", "m.", "it"]
    assert "moron," not in words and "moron," not in joined[:1] and "moron," in joined and "m.it" not in joined
    assert tk.windows("") == ([], []) and tk.windows(" \n") == ([], [])


def test_query_scores_are_the_machine_s(spark):
    """The query's scores, recomputed text by text from a machine fitted to the same sample."""
    rows = texts(300, 5)
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    pairs, share = tk.training_sample(df, labels)
    known = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5}
    assert pairs == sorted({(t, y) for i, t, y in rows if i in known}) and share == np.mean([y for i, _, y in rows if i in known])
    machine = tk.train([t for t, _ in pairs], [y for _, y in pairs], share)

    def plain(text):
        words, joined = tk.windows((text or "").lower())
        margin = lambda w: sum(machine.weights[c] * v for c, v in tk.features(w).items()) + machine.bias
        short = [w for w in words if margin(w) >= tk.LEAVE_FROM and tk.LEAVE_OUT[0] <= np.count_nonzero(tk._matrix([w])) <= tk.LEAVE_OUT[-1]]
        every = words + joined + [x for w in short for x in ["".join(c for c in w if tk.CODES[min(ord(c), 0xFFFF)])]
                                  for x in [x[:i] + x[i + 1:] for i in range(1, len(x) - 1)]]
        return max(map(margin, every), default=machine.bias)

    for r in tk.toxicity(df, labels).filter("doc_id % 10 = 0").collect():
        text = dict((i, t) for i, t, _ in rows).get(r.doc_id)
        assert r.score == pytest.approx(float(machine.probability(np.array([plain(text)]))[0]), abs=1e-3)


@pytest.mark.parametrize("way", ["inserted", "space"])
def test_spoilt_insults_are_predicted(way):
    """At least nine in ten spellings of the insults found, in clean texts, are predicted toxic."""
    train = texts(500, 1)
    machine = tk.train([t for _, t, _ in train], [y for *_, y in train])
    predicted = lambda t: machine.probability(np.array(tk.text_margins(machine, t))) >= 0.5
    clean = [t for _, t, y in texts(120, 6) if not y]
    assert np.mean(predicted(clean)) < 0.05
    spoilt = []
    for word in ("blockhead", "dimwit", "scumbag", "vermin"):
        assert predicted([f"on the {word} there"])[0]
        for i in range(1, len(word)):
            spoilt += [f"on the {word[:i]}{c}{word[i:]} there" for c in ("xkq7" if way == "inserted" else " ")]
    assert np.mean(predicted(spoilt)) >= 0.9
