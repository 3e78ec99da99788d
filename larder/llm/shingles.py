"""Hashes of words and word shingles, a whole slice of texts at a time.

A word is a run of letters, digits and underscores of the lower-cased text.
Its hash is a polynomial in its characters modulo 2**64, read off running sums
over the slice, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
#: Texts are hashed in slices of so many characters; a longer text is cut between words.
SLICE_CHARS = 2_000_000

_tables: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        size = max(n, SLICE_CHARS + 4096)
        up, down = (np.full(size, b, dtype=np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _tables["up"], _tables["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _tables["up"][:n], _tables["down"][:n]


def _in_words() -> np.ndarray:
    if "word" not in _tables:
        _tables["word"] = np.fromiter((chr(n).isalnum() or n == 95 for n in range(0x10000)), dtype=bool, count=0x10000)
    return _tables["word"]


def _segments(texts: Iterable[str]) -> Iterator[tuple[list[str], list[int]]]:
    """Slices of segments with the number of the text that each belongs to."""
    parts, owners, size = [], [], 0
    for n, text in enumerate(texts):
        text = text.lower()
        while text is not None:
            if len(text) > SLICE_CHARS:
                cut = text.find(" ", SLICE_CHARS - 1)  # a run without spaces stays whole
                head, text = (text, None) if cut < 0 else (text[:cut], text[cut + 1:])
            else:
                head, text = text, None
            if parts and size + len(head) > SLICE_CHARS:
                yield parts, owners
                parts, owners, size = [], [], 0
            parts.append(head)
            owners.append(n)
            size += len(head) + 1
    if parts:
        yield parts, owners


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """The hashes of each text's words, in order."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for parts, owners in _segments(texts):
        points = np.frombuffer("\n".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        ends = np.cumsum([len(p) + 1 for p in parts])
        inside = np.zeros(len(points) + 2, dtype=bool)
        inside[1:-1] = _in_words()[np.minimum(points, 0xFFFF)] | (points >= 0x20000)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edge[::2], edge[1::2]
        up, down = _powers(len(points) + 1)
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        cuts = np.searchsorted(first, ends)
        start = 0
        for owner, stop in zip(owners, cuts.tolist(), strict=True):
            out[owner].append(hashes[start:stop])
            start = stop
    return [p[0] if len(p) == 1 else np.concatenate(p) if p else np.empty(0, dtype=np.uint64) for p in out]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the shingles of ``k`` words; fewer words are one shingle."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    h = np.full(n, min(k, len(words)), dtype=np.uint64)
    for i in range(min(k, len(words))):
        h = (h + words[i:i + n]) * np.uint64(BASE)
        h ^= h >> np.uint64(32)
    return mix(h)


def sequence_key(words: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of a whole sequence of words."""
    up, _ = _powers(len(words) + 1)
    pair = np.array([np.sum(mix(words + np.uint64(salt)) * up[:len(words)], dtype=np.uint64) + np.uint64(len(words))
                     for salt in (1, 2)], dtype=np.uint64)
    return tuple(mix(pair).view(np.int64).tolist())
