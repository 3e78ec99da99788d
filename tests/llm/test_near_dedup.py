"""Operator 9 against a brute force over all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from larder.llm import icws
from larder.llm.shingles import SLICE_CHARS, shingle_hashes, word_hashes

WORD = re.compile(r"\w+")


def classes_of(rows, idf, similarity=icws.SIMILARITY):
    """Smallest identifier of each text's class, by all pairs."""
    sets = [shingle_hashes(w, icws.SHINGLE) for w in word_hashes([t or "" for _, t in rows])]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        alike = (rows[i][1] or "") == (rows[j][1] or "")
        if alike or (len(sets[i]) and len(sets[j]) and icws.weighted_jaccard(sets[i], sets[j], idf) >= similarity):
            root[find(i)] = find(j)
    least = {}
    for n, (doc, _) in enumerate(rows):
        least.setdefault(find(n), []).append((doc is None, doc))
    return [min(least[find(n)])[1] for n in range(len(rows))]


def idf_of(rows):
    counts = {}
    for w in word_hashes([t or "" for _, t in rows]):
        for slot in set(icws.slot_of(shingle_hashes(w, icws.SHINGLE)).tolist() if len(w) else []):
            counts[slot] = counts.get(slot, 0) + 1
    return icws.idf_table(counts, len(rows))


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{n}" for n in range(400)]
    text = lambda n: [rng.choice(words) for _ in range(n)]

    def change(base, n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(words) + "x"
        return out

    rows = [" ".join(text(rng.randint(1, 80))) for _ in range(60)]
    passage = text(40)
    rows += [" ".join(passage + text(60)) for _ in range(40)]  # a passage that many share
    near = text(150)
    rows += [" ".join(change(near, rng.randint(0, 2))) for _ in range(60)]  # a large near group
    for _ in range(15):
        base = text(90)
        rows += [" ".join(base), " ".join(change(base, 1)).upper(), ", ".join(base), " ".join(change(base, 12))]
    rows += [None, "", "", "...", "!!!", "one two", "One, two!", "one two", "a b c d e f", "é " * 9000]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("paired", [24, 3])
def test_classes_equal_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(icws, "PAIRED", paired)  # 3: nearly all buckets go by leaders
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, raw int, node string").repartition(3)
    got = icws.near_classes(df).collect()
    want = classes_of(rows, idf_of(rows))
    assert {r.doc_id: r.class_id for r in got} == {d: c for (d, _), c in zip(rows, want, strict=True)}
    size = {c: want.count(c) for c in want}
    assert all(r.class_size == size[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_kept_rows_null_and_repeated_identifiers(spark):
    rows = corpus(5)[:120]
    rows += [(None, rows[0][1]), (None, "text without id and without copies at all"), (rows[1][0], rows[1][1]), (rows[2][0], "another text, same id here now")]
    df = spark.createDataFrame([(7, t, d, 1.5) for d, t in rows], "row_id int, text string, doc_id long, raw double").repartition(3)
    kept = icws.one_of_each(df)
    assert kept.schema == df.schema
    want = classes_of(rows, idf_of(rows))
    by_text = {}
    for (_, text), c in zip(rows, want, strict=True):
        by_text.setdefault(text or "", c)
    got = kept.collect()
    assert len(got) == len({(c, any(d is None for (d, t), w in zip(rows, want, strict=True) if w == c and w is None)) for c in want} | {
        (by_text["another text, same id here now"], "other")})
    assert {r.doc_id for r in got} == set(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert icws.near_classes(df).count() == 0 and icws.one_of_each(df).count() == 0


def test_draws_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(1)
    draw = icws.Sampler(2000).draw
    for share in (0.3, 0.6, 0.9):
        shingles = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a = rng.uniform(0.5, 4, 300)
        b = np.where(rng.random(300) < share, a, a * rng.uniform(0.05, 1, 300))
        here = rng.random(300) < 0.5 + share / 2
        low = np.minimum(a, np.where(here, b, 0)).sum()
        true = low / (a.sum() + b[here].sum() - low)
        assert abs((draw(shingles, a) == draw(shingles[here], b[here])).mean() - true) < 4 * (true * (1 - true) / 2000) ** 0.5


def test_words_and_their_hashes():
    texts = ["", "  ", "Ein Wort, ein_Wort 3!", "日本 語 x", "a" * 50, "naïve NAÏVE", "x\n\ny", "\U00020000 z"]
    for t, h in zip(texts, word_hashes(texts), strict=True):
        assert len(h) == len(WORD.findall(t.lower()))
    one, two = word_hashes(["naïve b"])[0], word_hashes(["c NAÏVE"])[0]
    assert one[0] == two[1] and len({*one.tolist(), *two.tolist()}) == 3


def test_a_very_long_text_is_cut_between_words(monkeypatch):
    import larder.llm.shingles as sh
    text = " ".join(f"word{n}" for n in range(3000))
    whole = word_hashes([text, "b"])
    monkeypatch.setattr(sh, "SLICE_CHARS", 500)
    cut = word_hashes([text, "b"])
    assert [a.tolist() for a in whole] == [b.tolist() for b in cut] and SLICE_CHARS > 500
    long = word_hashes(["y" * 2000 + " z"])[0]
    assert len(long) == 2


def test_components_of_a_long_chain(spark):
    rng = random.Random(2)
    order = list(range(300))
    rng.shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1], 1.0) for i in range(299)] + [(1000, 1001, 1.0)], "a long, b long, similarity double")
    got = {r.node: r.root for r in icws.components(links).collect()}
    assert got == {**{n: 0 for n in range(300)}, 1000: 1000, 1001: 1000}
