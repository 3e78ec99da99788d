"""Benchmark decontamination with SimHash windows (operator 7).

A benchmark item leaks into a document when some window of the document with
as many words as the item has a weighted-shingle similarity of at least
``similarity`` to it.  Shingles are ``shingle`` words (a shorter item is one
shingle), weighted by the letters they hold, and the similarity is the
weighted Jaccard of the two multisets.

What a window can share with an item at most is the weight of its shingles that
stand anywhere in the item.  Of all starts in a document, those windows are made
for which this bound reaches the similarity that is asked for.  Each gets a 64-bit SimHash; the items'
fingerprints are indexed by blocks of bits, and probing every block value
within ``radius // blocks`` flips finds every fingerprint within ``radius``
(at least one block has no more flips than that).  The items found are
verified exactly.

Documents are only mapped, never shuffled: a passage that a third of all
documents share costs no more than a rare one.  The items are the query set.
They are sent to the executors in blocks of bounded count and bytes, and each
block runs against all documents.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 19, 4
#: Items, and bytes of their texts, that are sent to the executors at once.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16_000_000
#: Words of a text that are searched at once; pieces overlap by the longest item.
PIECE_WORDS = 200_000
WORD = re.compile(r"\w+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BITS = np.arange(64, dtype=np.uint64)

_INDEXES: dict[str, ItemIndex] = {}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingle_hashes(words: list[str], k: int) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(" ".join(words[i:i + k]).encode()) for i in range(len(words) - k + 1)]


def weighted(words: list[str], k: int) -> dict[int, float]:
    """Shingle hash -> occurrences times letters."""
    total: dict[int, float] = defaultdict(float)
    lens = [len(w) for w in words]
    for i, h in enumerate(shingle_hashes(words, k)):
        total[h] += sum(lens[i:i + k])
    return total


def similarity_of(a: dict[int, float], b: dict[int, float]) -> float:
    shared = sum(min(w, b[h]) for h, w in a.items() if h in b)
    union = sum(a.values()) + sum(b.values()) - shared
    return shared / union if union else 0.0


def fingerprint(features: dict[int, float]) -> int:
    hashes = np.fromiter(features, dtype=np.uint64, count=len(features))
    weights = np.fromiter(features.values(), dtype=np.float64, count=len(features))
    signs = ((hashes[:, None] >> BITS) & np.uint64(1)).astype(np.float64) * 2 - 1
    return int(np.sum((weights @ signs > 0).astype(np.uint64) << BITS, dtype=np.uint64))


class HammingBlocks:
    """Fingerprints by the value of each block of bits."""

    def __init__(self, prints: list[int], radius: int, blocks: int) -> None:
        self.prints = np.array(prints, dtype=np.uint64)
        self.radius, self.width = radius, 64 // blocks
        flips = radius // blocks
        self.masks = np.array([sum(1 << b for b in c) for n in range(flips + 1)
                               for c in itertools.combinations(range(self.width), n)], dtype=np.uint64)
        self.tables = []
        for n in range(blocks):
            value = self._block(self.prints, n)
            order = np.argsort(value, kind="stable")
            starts = np.searchsorted(value[order], np.arange((1 << self.width) + 1, dtype=np.uint64))
            self.tables.append((order, starts))

    def _block(self, prints, n: int):
        return (prints >> np.uint64(n * self.width)) & np.uint64((1 << self.width) - 1)

    def near(self, value: int) -> list[tuple[int, int]]:
        """(position, distance) of every fingerprint within the radius."""
        found: set[int] = set()
        for n, (order, starts) in enumerate(self.tables):
            probes = (self._block(np.uint64(value), n) ^ self.masks).astype(np.int64)
            low, high = starts[probes], starts[probes + 1]
            for a, b in zip(low[high > low], high[high > low], strict=True):
                found.update(order[a:b].tolist())
        at = np.array(sorted(found), dtype=np.int64)
        if not len(at):
            return []
        distance = np.bitwise_count(self.prints[at] ^ np.uint64(value))
        return [(int(i), int(d)) for i, d in zip(at, distance, strict=True) if d <= self.radius]


class ItemIndex:
    """What an executor needs of one block of items."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, similarity: float, radius: int, blocks: int) -> None:
        self.similarity = similarity
        self.vocabulary: dict[str, int] = {}
        self.ids, self.sizes, self.features, self.weights, prints = [], [], [], [], []
        postings: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = words_of(text or "")
            if not words:
                continue  # nothing to find
            k = min(shingle, len(words))
            features = weighted(words, k)
            own = len(self.ids)
            self.ids.append(item_id)
            self.sizes.append((len(words), k))
            self.features.append(features)
            self.weights.append(sum(features.values()))
            prints.append(fingerprint(features))
            codes = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.uint64)
            for h in set(self._rolled(codes, k).tolist()):
                postings[k][h].append(own)
        self.longest = max((n for n, _ in self.sizes), default=0)
        self.postings = {k: (np.array(sorted(p), dtype=np.uint64), p) for k, p in postings.items()}
        self.near = HammingBlocks(prints, radius, blocks).near if prints else (lambda _: [])

    @staticmethod
    def _rolled(codes: np.ndarray, k: int) -> np.ndarray:
        n = len(codes) - k + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        h = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            h = (h ^ codes[i:i + n]) * MULTIPLIER
            h ^= h >> np.uint64(29)
        return h

    def _windows(self, words: list[str]) -> set[tuple[int, int, int]]:
        """(start, words, shingle) of the windows that can be similar enough to
        an item of that size; a shorter text is one window."""
        codes = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), dtype=np.uint64, count=len(words))
        unknown = np.concatenate(([0], np.cumsum(codes == 0)))
        letters = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))))
        windows = set()
        for k, (hashes, postings) in self.postings.items():
            known = np.flatnonzero(unknown[k:] == unknown[:-k]) if len(words) >= k else []
            if not len(known):
                continue
            h = np.zeros(len(known), dtype=np.uint64)
            for i in range(k):
                h = (h ^ codes[known + i]) * MULTIPLIER
                h ^= h >> np.uint64(29)
            place = np.searchsorted(hashes, h)
            hit = np.flatnonzero(hashes[np.minimum(place, len(hashes) - 1)] == h)
            weight = letters[k:] - letters[:-k]
            shared: dict[int, list[int]] = defaultdict(list)
            for at, value in zip(known[hit].tolist(), h[hit].tolist(), strict=True):
                for item in postings[value]:
                    shared[item].append(at)
            upto = None
            for item, places in shared.items():
                own, at = self.weights[item], np.array(places)
                held = np.concatenate(([0], np.cumsum(weight[at])))
                if held[-1] < self.similarity * own - 1e-6:
                    continue
                if upto is None:
                    upto = np.concatenate(([0], np.cumsum(weight)))
                size = self.sizes[item][0]
                m = min(size, len(words)) - k + 1  # shingles of a window
                start = np.arange(max(0, places[0] - m + 1), min(max(len(words) - size, 0), places[-1]) + 1)
                most = np.minimum(held[np.searchsorted(at, start + m)] - held[np.searchsorted(at, start)], own)
                enough = most >= self.similarity * (own + upto[start + m] - upto[start] - most) - 1e-6
                windows.update((s, size, k) for s in start[enough].tolist())
        return windows

    def search(self, text: str | None) -> list[tuple[int, int, int, int, float]]:
        """(item_id, start word, words, distance, similarity), the best window of each item."""
        best: dict[int, tuple] = {}
        stream, tail, start = WORD.finditer((text or "").lower()), [], 0
        while True:
            fresh = [m[0] for m in itertools.islice(stream, PIECE_WORDS)]
            if not fresh:
                break
            words = tail + fresh
            for at, size, k in self._windows(words):
                features = weighted(words[at:at + size], min(k, len(words)))
                for item, distance in self.near(fingerprint(features)):
                    if self.sizes[item] != (size, k):
                        continue  # it has windows of its own size
                    likeness = similarity_of(features, self.features[item])
                    if likeness >= self.similarity:
                        found = (-likeness, start + at, min(size, len(words)), distance)
                        key = self.ids[item]
                        best[key] = min(best.get(key, found), found)
            tail = words[-self.longest:] if self.longest else []
            start += len(words) - len(tail)
        return [(item, at, size, distance, -score) for item, (score, at, size, distance) in sorted(best.items())]


def _index(token: str, sent, settings: tuple) -> ItemIndex:
    """Built once in each Python worker for each block of items."""
    if token not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[token] = ItemIndex(sent.value, *settings)
    return _INDEXES[token]


def _item_blocks(items: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks; a null identifier cannot be reported and is left out."""
    given = items.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    given = given.filter("item is not null").distinct()
    size = given.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(math.ceil(size.n / BLOCK_ITEMS), math.ceil((size.b or 0) / BLOCK_BYTES), 1)
    for n in range(blocks if size.n else 0):
        yield [(r.item, r.text) for r in given.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n).collect()]


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
          blocks: int = BLOCKS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, start_word,
    n_words, distance, similarity, for the item's best (then first) window.

    Words are runs of letters, digits and underscores, lower-cased.  Null and
    empty texts and items without a word match nothing; a document shorter
    than an item is compared as a whole; repeated rows count once; empty
    tables give an empty result; other columns are not read."""
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, start_word long, n_words int, distance int, similarity double"
    names = [f.strip().split()[0] for f in schema.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
    found = spark.createDataFrame([], schema)
    settings = (shingle, similarity, radius, blocks)
    for block in _item_blocks(items, item_id, item_text):
        sent = spark.sparkContext.broadcast(block)

        def search(batches, sent=sent, token=f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}"):
            index = _index(token, sent, settings)
            for batch in batches:
                rows = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                        for hit in index.search(text.as_py())]
                columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        found = found.unionByName(given.mapInArrow(search, schema))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start_word", "n_words", "distance")).alias("b")
    return (found.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.start_word", "b.n_words", "b.distance", (-F.col("b.s")).alias("similarity")))


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY,
                  radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns unchanged."""
    spark = docs.sparkSession
    settings = (shingle, similarity, radius, blocks)
    kept = docs
    for block in _item_blocks(items, item_id, item_text):
        sent = spark.sparkContext.broadcast(block)

        def clean(batches, sent=sent, token=f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}"):
            index = _index(token, sent, settings)
            for batch in batches:
                yield batch.filter(pa.array([not index.search(t.as_py()) for t in batch.column(text_col)], pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
