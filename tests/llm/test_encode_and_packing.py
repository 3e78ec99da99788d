"""Operators 1 and 8: ids against the tokenizers library, packing against a
naive best-fit decreasing, files against an exact round trip."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import best_fit, token_store
from larder.llm.common import work_path
from larder.llm.encode import encoder, slices, tokenizer_path

ODD = ["", " ", "  a  b ", "a \n b", "x\t y", "don't  we'll DON'T 's", "a b  c", " ̈a é e ́", "ΟΔΥΣΣΕΥΣ ΣΑΣ .Σ", "İstanbul ǅ",
       "1 234 5,6 !! ?? -- ", "\r\n a\u0085b", "日本語 テスト 🙂 👨‍👩‍👧", "<|endoftext|> a <|startoftext|>", "a" * 3000 + " " + "b" * 300,
       "x\x1cy ​  z ﻿q", "a\x00b \x0b c", "ẞ ß ﬁ K Å", "word " * 400]
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def reference(name, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_library(name):
    assert encoder(tokenizer_path(name)).encode(ODD) == reference(name, ODD)
    assert encoder(tokenizer_path(name)).encode(ODD[::-1]) == reference(name, ODD[::-1])  # chunks known by now


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZé ß'\n\t.,1２̈ΣsS "), max_size=40), max_size=6))
def test_ids_equal_the_library_on_random_texts(texts):
    for name in FILES:
        assert encoder(tokenizer_path(name)).encode(texts) == reference(name, texts)


def test_slices_cover_all_texts():
    texts = ["x" * n for n in (1, 5_000_000, 0, 3)] + [""] * 600
    got = list(slices(texts))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(texts)))
    assert list(slices([])) == []


def naive(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(n)
        else:
            bins.append([n])
    return bins


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120), st.integers(50, 64))
def test_plan_equals_best_fit_one_by_one(lengths, capacity):
    counts = {n: lengths.count(n) for n in lengths}
    plan = best_fit.plan_packing(counts, capacity)
    bins = {}
    for n, k in counts.items():
        for rank in range(k):
            step = np.searchsorted(plan.ranks[n], rank, side="right") - 1
            beyond, per = rank - plan.ranks[n][step], plan.per[n][step]
            bins.setdefault(int(plan.first[n][step] + beyond // per), []).append((int(plan.offset[n][step] + beyond % per * n), n))
    assert len(bins) == plan.sequences
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    want = naive(lengths, capacity)
    assert len(want) == plan.sequences
    assert sorted(sum(b) for b in want) == sorted(sum(n for _, n in p) for p in bins.values())


def test_segment_tree_finds_the_tightest():
    rng = random.Random(3)
    tree, rooms = best_fit.TightestFit(100), []
    for _ in range(300):
        room = rng.randint(1, 100)
        tree.add(room, 1)
        rooms.append(room)
        if rng.random() < 0.5:
            tree.add(rooms.pop(rng.randrange(len(rooms))), -1)
        least = rng.randint(1, 100)
        assert tree.find(least) == min((r for r in rooms if r >= least), default=None)


def rows_of(spark):
    texts = [None, "", "short", "word " * 5000, "a b c", "a b c", "ünïcödé ελ 日本 " * 30] + [f"doc {n} " * (n % 37) for n in range(150)]
    return spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)] + [(None, "no id", "x"), (4, "a b c", "x")],
                                 "doc_id long, text string, piece string").repartition(5), texts


def test_pieces_and_sequences(spark):
    df, texts = rows_of(spark)
    packed = best_fit.pack(best_fit.token_pieces(df, tokenizer_path("byte_bpe_50k.json")))
    rows = packed.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    ids = reference("byte_bpe_50k.json", [t or "" for t in texts])
    for n, want in enumerate(ids):
        want += b"\0\0\0\0"
        got = sorted(by_doc[n], key=lambda r: r.piece)
        if n == 4:
            assert len(got) == 2  # a repeated row is packed twice
            continue
        assert b"".join(bytes(r.ids) for r in got) == want
        assert [r.piece for r in got] == list(range(len(got)))
        assert all(r.length == 2048 for r in got[1:])
        assert [r.start for r in got] == [sum(x.length for x in got[:i]) for i in range(len(got))]
    assert len(by_doc[None]) == 1
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) == -(-total // 2048)
    made = best_fit.sequences(packed).collect()
    assert all(len(bytes(s.ids)) == 4 * s.length <= 4 * 2048 for s in made)
    assert sum(s.length for s in made) == total


def test_packing_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = best_fit.pack(best_fit.token_pieces(df, tokenizer_path("byte_bpe_50k.json")))
    assert out.count() == 0 and {"sequence_id", "offset"} <= set(out.columns)


def test_token_files_round_trip(spark):
    df, texts = rows_of(spark)
    df = df.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(token_store.round_trip(df, tokenizer_path("word_bpe_49k.json"), 2).collect())
    ids = [b + np.array([2], "<u4").tobytes() for b in reference("word_bpe_49k.json", [t or "" for t in texts])]
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    start = 0
    for r, want in zip(rows, ids, strict=True):
        assert (r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) == (start, len(want) // 4, zlib.crc32(want))
        start += r.n_tokens
    assert token_store.round_trip(df.limit(0), tokenizer_path("word_bpe_49k.json"), 2).count() == 0


def test_token_files_with_null_and_repeated_identifiers(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b c"), (1, "b c"), (0, None)], "doc_id long, text string")
    rows = token_store.round_trip(df, tokenizer_path("word_bpe_49k.json"), 2).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 0, 1, 1]
    assert [r.n_tokens for r in rows] == [2, 1, 3, 3] and [r.start for r in rows] == [0, 2, 3, 6]


def test_token_file_refuses_another_dictionary(spark):
    df, _ = rows_of(spark)
    folder = work_path(spark, "tokens-test")
    files = token_store.write_tokens(df.filter("doc_id < 9"), folder, tokenizer_path("word_bpe_49k.json"), 2)
    path = files.first().file
    fs, own = token_store.file_system(folder)
    from pyarrow.fs import FileSelector
    dictionary = next(f.path for f in fs.get_file_info(FileSelector(own)) if "dictionary-" in f.path)
    with fs.open_output_stream(dictionary) as out:
        out.write(b"something else")
    with pytest.raises(ValueError, match="another hash"):
        token_store.TokenFile(path)


def test_dictionary_of_too_few_samples_is_raw_content():
    assert len(token_store.train_dictionary([])) == 8
    token_store._dictionary(token_store.train_dictionary([b"abc"]))
