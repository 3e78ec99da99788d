"""Operators 1 and 8: names of added tokens in a text, against the library in its default setting."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from larder.llm import best_fit, token_store
from larder.llm.encode import encoder, tokenizer_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
TEXTS = ["end <|endoftext|> here", "<|endoftext|>", "a<|endoftext|><|startoftext|>  b", "<|ENDOFTEXT|> <|endoftext|", "", "plain",
         "e<|endoftext|>\u0301 x\x1c<|startoftext|>\n", " " * 200_000 + "<|endoftext|>" + "\n" * 200_000, None]


def library(name, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_library_by_default(name):
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "\n", "Aé", "e", "\u0301", "Σ", "ΟΣ", "'s", "1", "\x1f", "İ"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    want = [np.array(i, "<u4").tobytes() for i in library(name, texts)]
    assert encoder(tokenizer_path(name), added_tokens=True).encode(texts) == want


def test_pieces_and_token_files_hold_added_ids(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    end = np.array([2], "<u4").tobytes()
    want = [np.array(i, "<u4").tobytes() + end for i in library(FILES[1], TEXTS)]
    rows = token_store.round_trip(df, tokenizer_path(FILES[1]), 2).orderBy("doc_id").collect()
    starts = np.cumsum([0] + [len(w) // 4 for w in want]).tolist()
    assert [(r.start, zlib.crc32(bytes(r.ids))) for r in rows] == [(s, zlib.crc32(w)) for s, w in zip(starts, want)]
    pieces = best_fit.token_pieces(df, tokenizer_path(FILES[0])).orderBy("doc_id", "piece").collect()
    for n, ids in enumerate(library(FILES[0], TEXTS)):
        assert b"".join(bytes(p.ids) for p in pieces if p.doc_id == n) == np.array([*ids, 0], "<u4").tobytes()
