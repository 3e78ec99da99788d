"""Toxicity by a string-kernel support vector machine (operator 4).

The kernel counts the subsequences of three characters that two strings share.
A subsequence may have gaps: each skipped character multiplies its weight by
``DECAY``, and it spans at most ``SPAN`` characters.  Characters other than
letters and digits drop out first.  So a spelling with inserted or dropped
characters keeps most of the subsequences of the word it hides.

Strings are the windows of a sentence: its words, long words in overlapping
parts, short neighbouring words joined, since a space may have been put into a
word, and runs of single characters joined.  Landmarks are windows that tell
toxic from other sentences in the training sample, and windows of clean
sentences.  The Nystrom features of a window are its kernel values with the
landmarks, whitened; the machine is linear in them.  A toxic text need not be
toxic in every sentence: the windows that are clearly more frequent in toxic
texts stand for it, or where it has none, in each round the one that scores
highest.  Every sentence of a clean text is clean, and in each round its
highest windows are learnt as such.  The clear windows are learnt in spoilt
spellings, too: with a character put in, left out or doubled, wherever clean
texts have no such window.

Since the kernel is a sum over subsequences, the trained machine folds into
one weight per subsequence: scoring a window costs no kernel evaluation.  A
word of middling length that is not clearly clean is also scored without each
of its inner characters, since an inserted one breaks many subsequences of a short word.  A
text's score is that of its highest window, made a probability by a logistic
curve fitted to the sample, in which spoilt spellings count as toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECAY, SPAN, PART = 0.6, 6, 24
#: Bounds of the training sample: labelled rows of each class, and characters of a text that is used for it.
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 20_000
TOXIC_LANDMARKS, CLEAN_LANDMARKS, ROUNDS, PENALTY = 128, 128, 3, 3e-4
#: A window tells toxic texts clearly from so many of them on (and this share of all), and from this log ratio on.
CLEAR_TEXTS, CLEAR_SHARE, CLEAR_ODDS = 3, 0.01, 2.0
#: Two neighbouring words are one window, too, with so many characters in all, and under so many in one of them.
JOINED, FRAGMENT = range(4, 13), 4
#: The share of spoilt spellings in a clear window's mass.
SPOILT = 0.5
#: Sentences of a clean training text whose joined words are learnt.
JOINED_SENTENCES = 6
#: Lengths, and the least margin of the whole word, at which a character too many is looked for.
LEAVE_OUT, LEAVE_FROM = range(6, 13), -0.25
CACHE = 500_000
SENTENCE = re.compile(r"[.!?\n]+")
ENDS = ".!?"
SPELT = re.compile(r"(?<!\S)\S(?:\s\S){3,}(?!\S)")
#: Skips (a, b): the second character stands a behind the first, the third b behind the second.
SKIPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]


def _codes() -> np.ndarray:
    """A code from 1 to 63 for each letter and digit of the first plane, 0 for other characters."""
    table = np.zeros(0x10000, dtype=np.int32)
    for n in range(0x10000):
        if chr(n).isalnum():
            table[n] = 1 + n - 97 if 97 <= n <= 122 else 27 + n - 48 if 48 <= n <= 57 else 37 + n % 27
    return table


CODES = _codes()


def windows(sentence: str) -> tuple[list[str], list[str]]:
    """The windows of a lower-cased sentence (or text): words, and joined neighbours."""
    found = words = sentence.split()
    if SPELT.search(sentence):
        found = words + ["".join(m[0].split()) for m in SPELT.finditer(sentence)]
    if found and max(map(len, found)) > PART:
        found = [w[i:i + PART] for w in found for i in range(0, max(1, len(w) - PART // 2), PART // 2)]
    return found, [a + b for a, b in zip(words, words[1:])
                   if (len(a) < FRAGMENT or len(b) < FRAGMENT) and JOINED[0] <= len(a) + len(b) <= JOINED[-1] and a[-1] not in ENDS]


def spellings(window: str) -> list[str]:
    """A window with one character put in, left out or doubled inside."""
    inner = range(1, len(window))
    put_in = [window[:i] + "xaeqisonzr"[(i + n) % 10] + window[i:] for i in inner for n in (0, 3, 7)]
    doubled = [window[:i] + window[i - 1] + window[i:] for i in inner]
    return put_in + doubled + [window[:i] + window[i + 1:] for i in inner if len(window) > 4]


def _matrix(strings: list[str]) -> np.ndarray:
    size = max(map(len, strings))
    flat = "".join(s.ljust(size, "\0") for s in strings)
    points = np.frombuffer(flat.encode("utf-32-le"), dtype="<u4").reshape(len(strings), size)
    codes = CODES[np.minimum(points, 0xFFFF)]
    if not codes.all():  # other characters drop out
        order = np.argsort(codes == 0, axis=1, kind="stable")
        codes = np.take_along_axis(codes, order, axis=1)
        codes = codes[:, :max(1, int((codes > 0).sum(axis=1).max()))]
    return codes


def _subsequences(matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(codes, valid, weight) for each kind of gap."""
    for a, b in SKIPS:
        n = matrix.shape[1] - a - b
        if n <= 0:
            continue
        x, y, z = matrix[:, :n], matrix[:, a:a + n], matrix[:, a + b:]
        yield (x << 12) | (y << 6) | z, (x > 0) & (y > 0) & (z > 0), DECAY ** (a + b - 2)


def _by_length(strings: list[str], block: int = 8192) -> Iterator[np.ndarray]:
    order = np.argsort(np.fromiter(map(len, strings), dtype=np.int64, count=len(strings)), kind="stable")
    for at in range(0, len(order), block):
        yield order[at:at + block]


def _folded(matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
    total, norm = np.zeros(len(matrix), dtype=np.float32), np.full(len(matrix), 1e-9, dtype=np.float32)
    for code, valid, weight in _subsequences(matrix):
        total += weight * np.where(valid, weights[code], 0).sum(axis=1, dtype=np.float32)
        norm += weight * weight * valid.sum(axis=1, dtype=np.float32)
    return total / np.sqrt(norm)


def folded_scores(strings: list[str], weights: np.ndarray, leave_from: float = np.inf) -> np.ndarray:
    """sum of the weights of each string's subsequences over its norm.  Where
    that is ``leave_from`` or more and the string has ``LEAVE_OUT``
    characters: the greatest of it and those without one inner character."""
    out = np.zeros(len(strings))
    for at in _by_length(strings):
        matrix = _matrix([strings[i] for i in at])
        best = _folded(matrix, weights)
        near = np.flatnonzero(best >= leave_from)
        if len(near):
            size = (matrix[near] > 0).sum(axis=1)
            for gone in range(1, min(matrix.shape[1], LEAVE_OUT[-1]) - 1):
                rows = near[(size > gone + 1) & (size >= LEAVE_OUT[0]) & (size <= LEAVE_OUT[-1])]
                if len(rows):
                    best[rows] = np.maximum(best[rows], _folded(np.delete(matrix[rows], gone, axis=1), weights))
        out[at] = best
    return out


def features(string: str) -> dict[int, float]:
    """The normalised subsequence vector of one string."""
    found: Counter[int] = Counter()
    norm = 0.0
    if string:
        for code, valid, weight in _subsequences(_matrix([string])):
            for c in code[valid].tolist():
                found[c] += weight
                norm += weight * weight
    return {c: w / norm ** 0.5 for c, w in found.items()}


def kernel(a: str, b: str) -> float:
    """The gapped-subsequence kernel, over the norms of both strings."""
    x, y = features(a), features(b)
    return sum(w * y.get(c, 0.0) for c, w in x.items())


class Landmarks:
    """The landmarks' subsequence vectors, kept for the subsequences they hold."""

    def __init__(self, strings: list[str]) -> None:
        vectors = [features(s) for s in strings]
        self.codes = np.array(sorted(set().union(*vectors)), dtype=np.int64)
        self.row = np.full(1 << 18, -1, dtype=np.int32)
        self.row[self.codes] = np.arange(len(self.codes))
        self.matrix = np.zeros((len(self.codes), len(strings)), dtype=np.float32)
        for n, vector in enumerate(vectors):
            for code, weight in vector.items():
                self.matrix[self.row[code], n] += weight
        self.known: dict[str, np.ndarray] = {}

    def kernels(self, strings: list[str]) -> np.ndarray:
        """Kernel values of each string with each landmark."""
        for s in strings:
            if s not in self.known:
                own = features(s)
                rows = self.row[np.fromiter(own, dtype=np.int64, count=len(own))]
                weights = np.fromiter(own.values(), dtype=np.float32, count=len(own))
                self.known[s] = weights[rows >= 0] @ self.matrix[rows[rows >= 0]]
        return np.array([self.known[s] for s in strings], dtype=float).reshape(len(strings), self.matrix.shape[1])

    def folded(self, gamma: np.ndarray) -> np.ndarray:
        """One weight per subsequence: the sum of gamma times the landmarks."""
        out = np.zeros(1 << 18, dtype=np.float32)
        out[self.codes] = self.matrix @ gamma
        return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    ridge = np.full(len(beta), penalty * weight.sum())
    ridge[-1] *= 1e-3
    for _ in range(30):
        inside = y * (x @ beta) < 1
        rows, w = x[inside], weight[inside]
        new = np.linalg.solve((rows * w[:, None]).T @ rows + np.diag(ridge), rows.T @ (w * y[inside]))
        if np.allclose(new, beta, atol=1e-6):
            break
        beta = new
    return beta


@dataclass
class Machine:
    weights: np.ndarray  # per subsequence
    bias: float
    slope: float
    centre: float

    def margins(self, strings: list[str], leave_out: bool = True) -> np.ndarray:
        return folded_scores(strings, self.weights, LEAVE_FROM - self.bias if leave_out else np.inf) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin - self.centre), -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and centre of a logistic curve, lightly held to a slope of 4."""
    scale, a, b = max(float(np.std(x)), 1e-6), 4.0, 0.0
    z = (x - x.mean()) / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([np.sum(weight * (p - y) * z) + 0.05 * (a - 4), np.sum(weight * (p - y)) + 1e-3 * b])
        h = weight * p * (1 - p)
        hess = np.array([[np.sum(h * z * z) + 0.05, np.sum(h * z)], [np.sum(h * z), np.sum(h) + 1e-3]])
        step = np.clip(np.linalg.solve(hess, g), -2, 2)
        a, b = max(a - step[0], 0.1), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a / scale, float(x.mean() - b / a * scale)


def train(texts: list[str], labels: list[int], share: float | None = None, seed: int = 7) -> Machine:
    """Fits the machine to labelled texts; ``share`` is the share of toxic
    texts outside the sample, for the logistic curve.  Without texts of both
    classes every text gets the share (or, without any, 0) as its score."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, dtype=int)
    if len(set(labels)) < 2:
        sure = 40.0 if labels and labels[0] else -40.0
        return Machine(np.zeros(1 << 18, dtype=np.float32), 0.0, 1.0, -sure)
    place: dict[str, int] = {}  # windows by number
    number = lambda found: np.array([place.setdefault(w, len(place)) for w in found], dtype=np.int32)
    docs, sentences = [], [[windows(s) for s in SENTENCE.split(t.lower())] for t in texts]
    for found in sentences:
        docs.append([number(own) for own, _ in found if own])
    words = len(place)
    # Joined words tell nothing of toxic texts; of clean ones, some sentences' are learnt as clean.
    for doc, found, label in zip(docs, sentences, y, strict=True):
        some = [joined for _, joined in found if joined] if not label else []
        doc += [number(some[i]) for i in rng.permutation(len(some))[:JOINED_SENTENCES]]
    every = list(place)
    held = [np.unique(np.concatenate(doc)) if doc else np.empty(0, dtype=np.int32) for doc in docs]
    count = lambda label: np.bincount(np.concatenate([h for h, n in zip(held, y, strict=True) if n == label]), minlength=len(every))
    n1, n0 = int(y.sum()), int((1 - y).sum())
    toxic, clean = count(1), count(0)
    odds = np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))
    strength = np.where(toxic > 0, odds * np.sqrt(toxic), -1.0)  # both sure and frequent
    clear = (odds > CLEAR_ODDS) & (toxic >= max(CLEAR_TEXTS, CLEAR_SHARE * n1))
    best = sorted(np.argsort(-strength, kind="stable")[:4 * TOXIC_LANDMARKS].tolist(), key=lambda i: (-strength[i], every[i]))
    usable = [every[i] for i in best if odds[i] > 0 and toxic[i] and features(every[i])][:TOXIC_LANDMARKS]
    common = sorted(np.argsort(-clean, kind="stable")[:4 * CLEAN_LANDMARKS].tolist(), key=lambda i: (-clean[i], every[i]))
    seen = np.flatnonzero(clean)
    drawn = rng.choice(seen, min(len(seen), 2 * CLEAN_LANDMARKS), replace=False).tolist()
    half = CLEAN_LANDMARKS // 2
    usual = [every[i] for i in common if clean[i] and features(every[i])][:half]
    chance = [every[i] for i in drawn if features(every[i])][:half]
    landmarks = list(dict.fromkeys([*usable, *usual, *chance]))
    if not landmarks:  # no window is long enough for a subsequence
        return Machine(np.zeros(1 << 18, dtype=np.float32), 0.0, 1.0, 40.0)
    marks = Landmarks(landmarks)
    values, vectors = np.linalg.eigh(marks.kernels(landmarks))
    keep = values > 1e-4 * max(values.max(initial=0), 1e-9)
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    spoilt = {i: [w for w in spellings(every[i]) if w not in place or not clean[place[w]]] if len(every[i]) > 3 else []
              for i in np.flatnonzero(clear).tolist()}
    score = strength.astype(float)
    machine, hard = Machine(np.zeros(1 << 18, dtype=np.float32), -1.0, 1.0, 0.0), []
    for turn in range(ROUNDS):
        positive, negative = Counter(), Counter()
        for doc, own, label in zip(docs, held, y, strict=True):
            if not doc:
                continue
            if label:
                shown = own[clear[own]] if clear[own].any() else own[[int(score[own].argmax())]]
                for i in shown.tolist():
                    positive[every[i]] += 1 / len(shown)
            else:
                offer = np.array([s[int(score[s].argmax())] for s in doc])  # the highest window of each sentence
                negative.update(every[i] for i in offer[np.argsort(-score[offer], kind="stable")[:3]].tolist())
                negative.update(every[i] for i in doc[int(rng.integers(len(doc)))][:2].tolist())
        for w in [w for w in negative if len(w) in LEAVE_OUT]:
            negative.update(w[:i] + w[i + 1:] for i in range(1, len(w) - 1))
        for i in np.flatnonzero(clear).tolist():
            if positive[every[i]] and spoilt[i]:
                mass = positive[every[i]]
                positive[every[i]] = (1 - SPOILT) * mass
                for w in spoilt[i]:
                    positive[w] += SPOILT * mass / len(spoilt[i])
        hard = sorted({*hard, *negative}.difference(positive))
        strings = [*positive, *hard]
        side = np.array([1] * len(positive) + [-1] * len(hard))
        mass = np.array([*positive.values(), *(max(negative[w], 1) for w in hard)], dtype=float)
        for s in (1, -1):
            mass[side == s] /= max(mass[side == s].sum(), 1e-12)
        beta = _machine(marks.kernels(strings) @ whiten, side, mass, PENALTY)
        machine = Machine(marks.folded(whiten @ beta[:-1]), float(beta[-1]), 1.0, 0.0)
        score = np.concatenate([machine.margins(every[:words], turn > 0), machine.margins(every[words:], False)])
    top = np.array([score[h].max(initial=-1e9) if len(h) else machine.bias for h in held])
    share = n1 / len(y) if share is None else share
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    other = [w for own in spoilt.values() for w in own]
    if other:  # they count a quarter as much as the toxic texts
        top = np.concatenate([top, machine.margins(other)])
        y = np.concatenate([y, np.ones(len(other), dtype=int)])
        weight = np.concatenate([weight, np.full(len(other), share / 4 / len(other) * len(texts))])
    machine.slope, machine.centre = _logistic(top, y, weight)
    return machine


def text_margins(machine: Machine, texts: list[str | None], known: tuple[dict, dict] | None = None) -> list[float]:
    """The margin of each text's highest window.  ``known`` keeps those of words and of joined words."""
    known = ({}, {}) if known is None else known
    cut = [windows((t or "").lower()) for t in texts]
    for kind, margins in enumerate(known):
        if len(margins) > CACHE:
            margins.clear()
        new = list({w for c in cut for w in c[kind]}.difference(margins))
        if new:
            margins.update(zip(new, machine.margins(new, kind == 0).tolist(), strict=True))
    # An empty text has no window: its margin is that of no shared subsequence.
    return [max((max(map(margins.__getitem__, c), default=-1e9) for margins, c in zip(known, both, strict=True)))
            if both[0] else machine.bias for both in cut]


def _scored(sent, name: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        known: tuple[dict, dict] = ({}, {})
        for batch in batches:
            margins = []
            for at in range(0, batch.num_rows, 256):
                margins += text_margins(machine, batch.column(name).slice(at, 256).to_pylist(), known)
            p = machine.probability(np.array(margins, dtype=float))
            kept = [n for n in batch.schema.names if n != name]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(p, pa.float64())],
                                             names=[*kept, "score"])
    return score


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> tuple[list[tuple[str, int]], float]:
    """(texts and labels, share of toxic rows): at most ``rows`` labelled rows
    of each class outside the held-out fold, by a hash of the identifier."""
    given = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).filter(~held_out(id_col))
             .groupBy(F.col(id_col).alias("id_")).agg((F.max(label_col) > 0).cast("int").alias("toxic_")))
    sizes = {r.toxic_: r["count"] for r in given.groupBy("toxic_").count().collect()}
    chosen = None
    for label in (0, 1):
        own = given.filter(F.col("toxic_") == label).orderBy(F.xxhash64("id_"), "id_").limit(rows)
        chosen = own if chosen is None else chosen.unionByName(own)
    # Bounded: two narrow columns of at most 2 * rows rows.
    found = (docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
             .filter(F.length("text_").between(1, SAMPLE_CHARS)).join(F.broadcast(chosen), "id_"))
    # Copies would make the words of one text look frequent.
    pairs = sorted({(r.text_, r.toxic_) for r in found.collect()})
    total = sum(sizes.values())
    return pairs, sizes.get(1, 0) / total if total else 0.0


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, and ``carry``.

    Only the text decides the score.  Null and empty texts hold no window and
    get the score of a text that shares nothing with any landmark.  A label
    without a document, a null label and rows of the held-out fold are not
    learnt from; of several labels of one document the toxic one counts.
    Repeated rows score alike; an empty table gives an empty result."""
    spark = docs.sparkSession
    pairs, share = training_sample(docs, labels, id_col, text_col, label_col)
    machine = train([t for t, _ in pairs], [n for _, n in pairs], share if pairs else 0.0)
    sent = spark.sparkContext.broadcast(machine)
    given = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        *[F.col(c).alias(f"c{n}_") for n, c in enumerate(carry)], F.col(text_col).alias("scored_"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != "scored_")
    scored = given.mapInArrow(_scored(sent, "scored_"), f"{fields}, score double")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         *[F.col(f"c{n}_").alias(c) for n, c in enumerate(carry)])


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns unchanged."""
    names = [f"d{n}_" for n in range(len(docs.columns))]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    own = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
    return toxicity(rows, own, carry=tuple(names)).filter("predicted = 0").select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
