"""Token ids of whole texts, as the ``tokenizers`` library gives them.

A tokenizer file of either kind splits a text into words before it merges
bytes, so a text's ids are its words' ids in a row.

* Byte-level files (no normaliser, GPT-2's word pattern): the file's
  vocabulary is handed to ``tiktoken``, whose merges by rank are the same
  and whose whole-text loop is about five times faster.  Its pattern matcher
  panics in a run of a million white-space characters (one step to go back to
  for each), so long runs are cut out by the pattern's own rule and merged alone.
* Lower-case word files (white space dropped, ``</w>`` at word ends): white
  space cuts a text into chunks, and a worker keeps the ids of the chunks it
  has met.  New ones are normalised together by the library, cut into words by
  the file's own pattern, and merged together by ``tiktoken``, for which a line
  end behind each word stands for ``</w>`` (no word holds one).

The names of the file's added tokens ('<|endoftext|>') in a text are ordinary text
unless ``added_tokens`` is set; then a text is cut at them first, and they give
their own ids, as in the library's default setting.

``tests/llm/test_encode_and_packing.py`` holds both against ``Tokenizer.encode``.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable
from functools import cached_property

import numpy as np

#: Distinct chunks that a worker keeps; then it starts anew.  Longer ones are not kept.
CACHE_CHUNKS, CACHE_CHARS = 400_000, 48
#: Texts, or so many characters of them, that are encoded together.
SLICE_TEXTS, SLICE_CHARS = 256, 4_000_000
GPT2_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White-space characters in a row that are left to ``tiktoken``'s matcher; 2,000,000 make it panic.
SAFE_RUN = 100_000
#: Runs of what the pattern takes as white space (Python's ``\s`` has four more characters).
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

#: Stands between chunks that are encoded together.
MARK = "\x1f"
#: str.split() also cuts at these, which are no white space to the files' patterns.
CONTROLS = re.compile(r"[\x1c-\x1f]")

_ENCODERS: dict[tuple[str, bool], ByteEncoder | WordEncoder | AddedTokens] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteEncoder:
    def __init__(self, given: dict) -> None:
        import tiktoken

        byte = _byte_of()
        ranks = {bytes(byte[c] for c in piece): n for piece, n in given["model"]["vocab"].items()}
        self.core = tiktoken.Encoding("file", pat_str=GPT2_WORDS, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def run(self):
        """Takes white space as one word; made for the first long run."""
        import tiktoken

        return tiktoken.Encoding("run", pat_str=r"\s+", mergeable_ranks=self.core._mergeable_ranks, special_tokens={})

    def _ids(self, text: str) -> bytes:
        start, parts = 0, []
        for run in SPACES.finditer(text) if len(text) > SAFE_RUN else ():
            a, b = run.span()
            if b - a > SAFE_RUN:
                b -= b < len(text)  # the last one goes to what follows
                parts += self.core.encode_ordinary(text[start:a]), self.run.encode_ordinary(text[a:b])
                start = b
        parts.append(self.core.encode_ordinary(text[start:]))
        return b"".join(array("I", p).tobytes() for p in parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._ids(t) for t in texts]


class WordEncoder:
    def __init__(self, path: str, given: dict) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        pattern = given["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if "[^\\s" not in pattern:
            raise ValueError(f"{path}: an unknown word pattern")
        self.words = regex.compile(MARK + "|" + pattern.replace("[^\\s", "[^\\s" + MARK)).findall
        byte, special = _byte_of(), {t["id"] for t in given["added_tokens"]}
        ranks = {}
        for piece, n in given["model"]["vocab"].items():
            if n not in special:
                body = piece.removesuffix("</w>")
                ranks[bytes(byte[c] for c in body) + b"\n" * (body != piece)] = n
        self.mark = ranks[MARK.encode() + b"\n"]
        self.core = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
        self.chunks: dict[str, bytes] = {}

    def _learn(self, new: list[str], normal: str) -> None:
        """Keeps the ids of new chunks; ``normal`` is their normalised text."""
        marked = "\n".join(self.words(normal + MARK)) + "\n"
        ids = np.array(self.core.encode_ordinary(marked), dtype="<u4")
        ends, data, start = np.flatnonzero(ids == self.mark) * 4, ids.tobytes(), 0
        for chunk, end in zip(new, ends.tolist(), strict=True):
            self.chunks[chunk] = data[start:end]
            start = end + 4

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks = {}
        chunks = self.chunks
        odd = {i for i, t in enumerate(texts) if CONTROLS.search(t)}
        cut = [[] if i in odd else t.split() for i, t in enumerate(texts)]
        new = set().union(*cut).difference(chunks)
        plain, other = [c for c in new if c.isascii()], [c for c in new if not c.isascii()]
        if plain:
            self._learn(plain, MARK.join(plain).lower())
        if other:
            self._learn(other, self.tokenizer.normalizer.normalize_str(MARK.join(other)))
        out = [b"".join(map(chunks.__getitem__, c)) for c in cut]
        for i in odd:
            out[i] = array("I", self.tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes()
        for chunk in new:
            if len(chunk) > CACHE_CHARS:
                del chunks[chunk]
        return out


class AddedTokens:
    """Cuts texts at the names of added tokens; what lies between is encoded as a text of its own."""

    def __init__(self, within: ByteEncoder | WordEncoder, path: str, tokens: list[dict]) -> None:
        if any(t[k] for t in tokens for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens with rules of their own are not known")
        self.within, self.ids = within, {t["content"]: array("I", [t["id"]]).tobytes() for t in tokens}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + ")").split

    def encode(self, texts: list[str]) -> list[bytes]:
        held = {i: self.cut(t) for i, t in enumerate(texts) if any(name in t for name in self.ids)}
        if not held:
            return self.within.encode(texts)
        parts = [held.get(i, [t]) for i, t in enumerate(texts)]  # names at the odd places
        between = iter(self.within.encode([p for own in parts for p in own[::2]]))
        return [b"".join(self.ids[p] if n % 2 else next(between) for n, p in enumerate(own)) for own in parts]


def encoder(path: str, added_tokens: bool = False) -> ByteEncoder | WordEncoder | AddedTokens:
    """One per worker, so that the words it knows serve all its tasks.

    ``encode(texts)`` gives the little-endian unsigned 32-bit ids of each;
    with ``added_tokens`` their names in a text give their ids."""
    if (path, added_tokens) not in _ENCODERS:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        if added_tokens and given["added_tokens"]:
            _ENCODERS[path, True] = AddedTokens(encoder(path), path, given["added_tokens"])
            return _ENCODERS[path, True]
        kind = (given.get("normalizer"), (given.get("pre_tokenizer") or {}).get("type"))
        if kind == (None, "ByteLevel"):
            _ENCODERS[path, added_tokens] = ByteEncoder(given)
        elif given["model"].get("end_of_word_suffix") == "</w>":
            _ENCODERS[path, added_tokens] = WordEncoder(path, given)
        else:
            raise ValueError(f"{path}: only byte-level and lower-case word files are known")
    return _ENCODERS[path, added_tokens]


def vocabulary_size(path: str) -> int:
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    return 1 + max([*given["model"]["vocab"].values(), *(t["id"] for t in given["added_tokens"])])


def slices(texts: list[str]) -> Iterable[tuple[int, int]]:
    """Ranges of texts to encode together; a very long text is encoded alone."""
    start, chars = 0, 0
    for at, text in enumerate(texts):
        if at > start and (at - start >= SLICE_TEXTS or chars + len(text) > SLICE_CHARS):
            yield start, at
            start, chars = at, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)
