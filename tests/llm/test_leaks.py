"""Operator 7 against a brute force over all windows."""

import random

import numpy as np

from larder.llm import leak_simhash as ls


def brute(docs, items):
    """Best similarity of every pair, over all windows of the item's size."""
    found = {}
    for doc, text in docs:
        words = ls.words_of(text or "")
        for item, wanted in items:
            target = ls.words_of(wanted or "")
            if not target or not words:
                continue
            k = min(ls.SHINGLE, len(target))
            own = ls.weighted(target, k)
            n = len(target)
            best = 0.0
            for at in range(max(1, len(words) - n + 1)):
                window = words[at:at + n]
                best = max(best, ls.similarity_of(ls.weighted(window, min(k, len(window))), own))
            if best >= ls.SIMILARITY:
                found[doc, item] = round(best, 9)
    return found


def corpus():
    rng = random.Random(8)
    words = ["alpha", "beta", "of", "the", "gamma", "a", "zeta", "is", "é1", "omega"] + [f"w{n}" for n in range(200)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(n, text(rng.randint(12, 60))) for n in range(25)] + [(90, "Only three words"), (91, ""), (92, None), (93, "one"), (94, "??")]
    docs = [(n, text(rng.randint(0, 120))) for n in range(60)] + [(200, None), (201, ""), (202, "one"), (203, "only, THREE words!")]
    for n in range(25):
        whole = items[n][1].split()
        docs.append((300 + n, text(40) + ". " + items[n][1].upper() + " " + text(30)))
        long = whole * 2 if len(whole) < 30 else whole
        changed = whole[:len(whole) // 2] + (["changed"] if n % 2 else []) + whole[len(whole) // 2 + (n % 3 == 0):]
        docs.append((400 + n, text(9) + " " + " ".join(changed) + " " + text(20)))
        docs.append((500 + n, " ".join(whole[:len(whole) // 2])))
        docs.append((600 + n, " ".join(long)))
    return docs, items


def test_leaks_equal_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string").repartition(4)
    found = ls.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == want
    assert {(300 + n, n) for n in range(25)} <= set(want)
    assert (203, 90) in want and (202, 93) in want
    kept = ls.without_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.schema == df.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {p[0] for p in want})


def test_long_texts_are_cut_without_loss(monkeypatch):
    docs, items = corpus()
    index = ls.ItemIndex(items, ls.SHINGLE, ls.SIMILARITY, ls.RADIUS, ls.BLOCKS)
    text = " ".join(t or "" for _, t in docs)
    whole = index.search(text)
    monkeypatch.setattr(ls, "PIECE_WORDS", 100)
    assert index.search(text) == whole and len(whole) >= 25


def test_items_in_blocks_repeated_rows_and_empty_tables(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 7)
    df = spark.createDataFrame(docs + docs[:70] + [(None, items[3][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items + items + [(None, "no id of five words here")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in ls.leaks(df, bench).collect()}
    assert got.pop((None, 3)) == 1.0
    assert got == brute(docs, items)
    assert ls.leaks(df.limit(0), bench).count() == 0 and ls.leaks(df, bench.limit(0)).count() == 0
    assert ls.without_leaks(df, bench.limit(0)).count() == df.count()


def test_block_index_finds_all_within_the_radius():
    rng = np.random.default_rng(6)
    prints = [int(x) for x in rng.integers(0, 2**64, size=400, dtype=np.uint64)]
    index = ls.HammingBlocks(prints, ls.RADIUS, ls.BLOCKS)
    for n in range(60):
        value = prints[n]
        for bit in rng.choice(64, size=int(rng.integers(0, 30)), replace=False):
            value ^= 1 << int(bit)
        want = sorted((i, (p ^ value).bit_count()) for i, p in enumerate(prints) if (p ^ value).bit_count() <= ls.RADIUS)
        assert index.near(value) == want
