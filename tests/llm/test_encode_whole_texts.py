"""Operators 1 and 8: texts that ``tiktoken`` alone cannot read."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from larder.llm.encode import SAFE_RUN, encoder, tokenizer_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" + "　" * 1_000_000 + "b"])
def test_millions_of_white_space_characters(name, text):
    assert encoder(tokenizer_path(name)).encode([text]) == library(name, [text])


@pytest.mark.parametrize("name", FILES)
def test_long_runs_beside_all_kinds_of_characters(name):
    n = SAFE_RUN
    runs = [" " * (n - 1), " " * n, " " * (n + 1), "\n" * (n + 7), "\t " * n, " \r\n" * n, "\x85\xa0" * n, " " * n + "\n"]
    texts = [a + run + b for run in runs for a, b in (("", ""), ("a", ""), ("", "b"), ("x 1", "'s !"), ("é.", "7"), ("a\x1c", "\x1fb"))]
    texts.append("a" + runs[2] + "b  c" + runs[3] + "\x1c" + runs[4] + "!")
    assert encoder(tokenizer_path(name)).encode(texts) == library(name, texts)
