"""Ids straight from the tokenizers library."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer


def reference_ids(name, texts, end_id):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [np.array([*e.ids, end_id], "<u4") for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
