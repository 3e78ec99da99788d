"""Language-model scoring with a log-bilinear model (operator 5).

Counts of all training tokens come first; they give the unigram base and the
model's units: the ``WORDS`` most frequent tokens, and for all others ``CLASSES``
classes by the token's last letters.  The model predicts the next unit from the
two before it: the context vector is the sum of both units' vectors, each times
a matrix of its position, and a unit's score is its product with the context
vector plus a bias.  Inside a class a token has its smoothed share of the
class's counts, so every token, known or not, has a probability and they add
up to one.

Texts are cut into tokens twice: to count them, and, once the vocabulary is
fixed, to store their units, two bytes a token, which training and scoring read.

Training is noise-contrastive estimation in numpy, on all training rows: every
task runs over its rows from the same start, and the results are averaged by
tokens, after a first round on a part of the rows.  Since a score is a sum of
one term per position, the normalisers of all contexts are one matrix product
of the exponentiated terms; scoring a token is then four look-ups.

Frequent tokens are looked up in a table of at most ``HEAD`` entries that every
task holds.  The others are joined with their counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored

WORDS, CLASSES, HEAD = 1500, 256, 400_000
DIMENSIONS, NOISE, BATCH, RATE = 16, 128, 2048, 0.15
#: Tokens that a task should get, and that it sees at least: it goes over a smaller table again.
TASK_TOKENS, LEAST_TOKENS = 4_000_000, 2_000_000
#: Tokens that are shuffled together.
BLOCK = 1 << 18
#: Every so-manieth training row takes part in the first round.
FIRST_ROUND = 8
#: Distinct tokens that a task counts before it hands them on.
COUNTED = 500_000
#: The end of a text; no token holds white space.
END = b"\n"


def tokens_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space, and one end."""
    found = (text or "").encode().lower().split()
    found.append(END)
    return found


def class_of(token: bytes) -> int:
    return zlib.crc32(token[-3:]) % CLASSES


def held_out(id_col: str, folds: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        columns = [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["token", "n"])

    for batch in batches:
        for text in batch.column("text"):
            total.update(tokens_of(text.as_py()))
            if len(total) > COUNTED:
                yield out()
                total.clear()
    yield out()


def _class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mass = np.zeros(CLASSES)
    for batch in batches:
        for token, n in zip(batch.column("token").to_pylist(), batch.column("n").to_pylist(), strict=True):
            mass[class_of(token)] += n + 0.1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(mass)], names=["class", "mass"])


@dataclass
class Vocabulary:
    """What every task holds: at most ``HEAD`` tokens."""

    tokens: list[bytes]  # the first ``words`` of them are units
    counts: np.ndarray
    words: int
    mass: np.ndarray  # of each class: its tokens' counts, each plus 0.1
    total: int
    distinct: int

    def __post_init__(self) -> None:
        self.units = self.words + CLASSES
        self.end = 0  # the end is always the first unit
        self.place = {t: n for n, t in enumerate(self.tokens)}
        rest = np.fromiter((self.words + class_of(t) for t in self.tokens[self.words:]), dtype=np.int64,
                           count=len(self.tokens) - self.words)
        self.unit = np.concatenate([np.arange(self.words), rest])
        log_share = np.log10(self.counts + 0.1)
        self.inside = np.where(np.arange(len(self.tokens)) < self.words, 0.0, log_share)  # numerator only
        self.base = log_share - self.log_denominator
        self.class_log = np.concatenate([np.zeros(self.words), np.log10(self.mass + 0.1)])

    @property
    def log_denominator(self) -> float:
        return float(np.log10(self.total + 0.1 * (self.distinct + 1)))

    def unit_counts(self) -> np.ndarray:
        return np.concatenate([self.counts[:self.words], self.mass]) + 1.0

    def units_of(self, tokens: list[bytes], classes: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table or -1, unit) of each token."""
        at = np.fromiter(map(self.place.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
        unit = self.unit[at] if len(self.unit) else np.zeros(len(at), dtype=np.int64)
        for i in np.flatnonzero(at < 0).tolist():
            t = tokens[i]
            c = classes.get(t)
            if c is None:
                c = classes[t] = class_of(t)
            unit[i] = self.words + c
        return at, unit


@dataclass
class Parameters:
    context: np.ndarray  # units x d
    output: np.ndarray  # units x d
    first: np.ndarray  # d x d, for the token before
    second: np.ndarray  # d x d, for the one before that
    bias: np.ndarray

    @staticmethod
    def start(counts: np.ndarray, d: int = DIMENSIONS, seed: int = 11) -> Parameters:
        rng = np.random.default_rng(seed)
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        eye = np.eye(d, dtype=np.float32)
        bias = np.log(counts / counts.sum()).astype(np.float32)
        return Parameters(small(len(counts), d), small(len(counts), d), eye.copy(), eye * np.float32(0.5), bias)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in vars(self).values()])

    def like(self, flat: np.ndarray) -> Parameters:
        cut = np.split(flat.astype(np.float32), np.cumsum([x.size for x in vars(self).values()])[:-1])
        return Parameters(*(c.reshape(x.shape).copy() for c, x in zip(cut, vars(self).values(), strict=True)))


def _sigmoid_of_negative(x: np.ndarray) -> np.ndarray:
    """The sigmoid of -x, in the place of x."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _summed(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each index; one count per column beats np.add.at."""
    out = np.empty((rows.shape[1], n), dtype=np.float32)
    for column, values in zip(out, np.ascontiguousarray(rows.T), strict=True):
        column[:] = np.bincount(index, values, n)
    return np.ascontiguousarray(out.T)


class Trainer:
    """Noise-contrastive estimation with one draw of noise per batch."""

    def __init__(self, parameters: Parameters, counts: np.ndarray, seed: int) -> None:
        self.p, self.rng = parameters, np.random.default_rng(seed)
        share = counts / counts.sum()
        self.cumulated, self.log_noise = np.cumsum(share), np.log(NOISE * share).astype(np.float32)
        self.squares = {k: np.full_like(v, 1e-6) for k, v in vars(parameters).items()}

    def _step(self, name: str, gradient: np.ndarray) -> None:
        square, value = self.squares[name], getattr(self.p, name)
        square += gradient * gradient
        value += RATE * gradient / np.sqrt(square)

    def batch(self, two: np.ndarray, one: np.ndarray, word: np.ndarray) -> None:
        p = self.p
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(self.cumulated) - 1)
        c1, c2, target, other = p.context[one], p.context[two], p.output[word], p.output[noise]
        h = c1 @ p.first + c2 @ p.second
        data = np.einsum("ij,ij->i", h, target) + p.bias[word] - self.log_noise[word]
        # One product gives the noise scores with their biases; ``down`` is how far each is taken for data.
        lifted = np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)
        false = lifted @ np.concatenate([-other, (self.log_noise[noise] - p.bias[noise])[:, None]], axis=1).T
        up, down = _sigmoid_of_negative(data), _sigmoid_of_negative(false)
        dh = up[:, None] * target - down @ other
        units = len(p.bias)
        output = _summed(np.concatenate([word, noise]), np.concatenate([up[:, None] * h, -(down.T @ h)]), units)
        context = _summed(np.concatenate([one, two]), np.concatenate([dh @ p.first.T, dh @ p.second.T]), units)
        bias = np.bincount(np.concatenate([word, noise]), np.concatenate([up, -down.sum(axis=0)]), units).astype(np.float32)
        for name, gradient in (("output", output), ("context", context), ("first", c1.T @ dh), ("second", c2.T @ dh),
                               ("bias", bias)):
            self._step(name, gradient / len(word))

    def block(self, two: np.ndarray, one: np.ndarray, word: np.ndarray) -> None:
        order = self.rng.permutation(len(word))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            self.batch(two[rows], one[rows], word[rows])


def contexts(units: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The units two and one before each; an end stands before the text."""
    padded = np.concatenate([[end, end], units])
    return padded[:-2], padded[1:-1]


def _unpacked(units: pa.Scalar) -> np.ndarray:
    return np.frombuffer(units.as_buffer(), dtype="<u2").astype(np.int64)


def _train(sent, seed: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = sent.value
        trainer = Trainer(start.like(start.flat()), vocabulary.unit_counts(), seed)
        kept, open_, held, seen = [], [], 0, 0

        def close() -> int:
            block = tuple(np.concatenate(c) for c in zip(*open_, strict=True))
            trainer.block(*block)
            if seen < LEAST_TOKENS:
                kept.append(block)
            return len(block[0])

        for batch in batches:
            for units in batch.column("units"):
                unit = _unpacked(units)
                open_.append((*contexts(unit, vocabulary.end), unit))
                held += len(unit)
                if held >= BLOCK:
                    seen += close()
                    open_, held = [], 0
        if open_:
            seen += close()
        own = seen
        while 0 < seen < LEAST_TOKENS:
            for block in kept:
                trainer.block(*block)
                seen += len(block[0])
        if own:
            yield pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int64()), pa.array([(trainer.p.flat().astype(np.float64) * own).tobytes()], pa.binary())],
                names=["tokens", "sum"])
    return train


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        for tokens, blob in zip(batch.column("tokens").to_pylist(), batch.column("sum").to_pylist(), strict=True):
            values = np.frombuffer(blob)
            n, total = n + tokens, values.copy() if total is None else total + values
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["tokens", "sum"])


def _round(rows: DataFrame, tokens: int, vocabulary: Vocabulary, start: Parameters, seed: int) -> Parameters:
    """Trains on every partition from ``start`` and averages by tokens; small
    partitions are read together."""
    rows = rows.coalesce(max(1, -(-tokens // TASK_TOKENS)))
    sent = rows.sparkSession.sparkContext.broadcast((vocabulary, start))
    schema = "tokens long, sum binary"
    results = stored(rows.mapInArrow(_train(sent, seed), schema), "lbl-round")
    lanes = max(1, int(results.count() ** 0.5))  # so the driver gets the root of as many vectors
    total = [(r.tokens, np.frombuffer(bytes(r["sum"]))) for r in results.repartition(lanes).mapInArrow(_added, schema).collect()]
    return start.like(sum(v for _, v in total) / sum(n for n, _ in total)) if total else start


def learn_vocabulary(train: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """(vocabulary, counts of the training tokens that it leaves out) of texts."""
    counts = stored(train.select("text").mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")), "token-counts")
    size = F.floor(F.log2("n") * 16).cast("int")
    sums = {r.s: r for r in counts.groupBy(size.alias("s")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()}
    least, room = max(sums, default=0) + 1, HEAD
    for s in sorted(sums, reverse=True):
        room -= sums[s].v
        if room < 0:
            break
        least = s
    # The end is always in the table, with count 0 where there is no training text.
    frequent = (size >= least) | (F.col("token") == F.lit(END))
    head = {END: 0} | {bytes(r.token): r.n for r in counts.filter(frequent).collect()}
    head = sorted(head.items(), key=lambda r: (r[0] != END, -r[1], r[0]))
    words = min(WORDS, len(head))
    tail = counts.filter(~frequent)
    mass = np.zeros(CLASSES)
    for r in tail.mapInArrow(_class_sums, "class long, mass double").groupBy("class").agg(F.sum("mass").alias("m")).collect():
        mass[r["class"]] += r.m
    for token, n in head[words:]:
        mass[class_of(token)] += n + 0.1
    vocabulary = Vocabulary([t for t, _ in head], np.array([n for _, n in head], dtype=np.int64), words, mass,
                            sum(r.n for r in sums.values()), sum(r.v for r in sums.values()))
    return vocabulary, tail


def _encode(sent):
    rare = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), rare, pa.binary()]
    names = ["doc_id", "held_out", "n_tokens", "known", "base", "inside", "rare", "units"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        classes: dict[bytes, int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part, rows = batch.slice(start, 256), []
                for doc, out, text in zip(*(part.column(c) for c in ("doc_id", "held_out", "text")), strict=True):
                    tokens = tokens_of(text.as_py())
                    at, unit = v.units_of(tokens, classes)
                    known = at >= 0
                    others = Counter(tokens[i] for i in np.flatnonzero(~known).tolist())
                    found = at[known]
                    base = v.base[found].sum() - v.log_denominator * (len(at) - len(found))
                    inside = v.inside[found].sum() - v.class_log[unit].sum()
                    rows.append((doc.as_py(), out.as_py(), len(tokens), int((v.counts[found] > 0).sum()), float(base), float(inside),
                                 [{"token": t, "n": n} for t, n in others.items()], unit.astype("<u2").tobytes()))
                if len(classes) > COUNTED:
                    classes.clear()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return encode


def encoded(given: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, held_out, text) rows with the units of their tokens, two
    bytes each, and all of their scores that no model decides, stored: every
    later step reads units, and no text is cut into tokens again."""
    sent = given.sparkSession.sparkContext.broadcast(vocabulary)
    rows = given.select("doc_id", "held_out", "text").mapInArrow(
        _encode(sent), "doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, "
                       "rare array<struct<token:binary,n:bigint>>, units binary")
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), "lbl-encoded")


def train_model(rows: DataFrame, vocabulary: Vocabulary) -> Parameters:
    """The parameters after a round on some of the encoded rows and one on all."""
    parameters = Parameters.start(vocabulary.unit_counts())
    units = rows.select("units")
    first = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_ROUND)) == 0).select("units")
    for seed, (some, share) in enumerate(((first, FIRST_ROUND), (units, 1))):
        parameters = _round(some, vocabulary.total // share, vocabulary, parameters, seed)
    return parameters


def fit(train: DataFrame) -> tuple[Vocabulary, Parameters, DataFrame]:
    """(vocabulary, parameters, counts of the tokens left out of it) of (doc_id, text) rows."""
    vocabulary, tail = learn_vocabulary(train)
    return vocabulary, train_model(encoded(train.withColumn("held_out", F.lit(False)), vocabulary), vocabulary), tail


class Scorer:
    """Normalised log10 probabilities of units after two units."""

    def __init__(self, vocabulary: Vocabulary, p: Parameters) -> None:
        self.v = vocabulary
        one = (p.context @ p.first) @ p.output.T + p.bias
        two = (p.context @ p.second) @ p.output.T
        top1, top2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        self.one, self.two = one - top1, two - top2
        self.log_z = np.log(np.maximum(np.exp(self.one) @ np.exp(self.two).T, 1e-30))

    def log10(self, two: np.ndarray, one: np.ndarray, word: np.ndarray) -> np.ndarray:
        return (self.one[one, word] + self.two[two, word] - self.log_z[one, two]).astype(np.float64) / np.log(10)


_SCORERS: dict[str, Scorer] = {}


def _score(sent, key: str):
    kept = ["uid", "doc_id", "held_out", "n_tokens", "known", "base"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(*sent.value)
        scorer = _SCORERS[key]
        for batch in batches:
            model = batch.column("inside").to_numpy().copy()
            for n, packed in enumerate(batch.column("units")):
                unit = _unpacked(packed)
                model[n] += scorer.log10(*contexts(unit, scorer.v.end), unit).sum()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(model)], names=[*kept, "model"])
    return score


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text.

    Learns from the rows whose crc32(identifier as text) mod ``folds`` is not
    0.  A null text is empty and has only its end; a null identifier counts as
    an empty one; a very long text is scored whole; other columns are not looked at.  Without training rows the base is 0 and the model spreads
    evenly over the end and the classes.  Repeated rows each count; an empty
    table gives an empty result."""
    given = df.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, folds).alias("held_out"),
                      F.col(text_col).alias("text"))
    vocabulary, tail = learn_vocabulary(given.filter("not held_out"))
    rows = encoded(given, vocabulary)
    parameters = train_model(rows.filter("not held_out"), vocabulary)
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((vocabulary, parameters))
    key = f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}"
    scored = rows.drop("rare").mapInArrow(_score(sent, key), "uid long, doc_id long, held_out boolean, n_tokens long, known long, "
                                                             "base double, model double")
    rare = rows.select("uid", F.inline("rare").alias("token", "n"))
    joined = rare.join(tail.withColumnRenamed("n", "c"), "token", "left")
    more = joined.groupBy("uid").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("more"),
                                     F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("found"))
    added = F.coalesce("more", F.lit(0.0))
    return scored.join(more, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), (F.col("base") + added).alias("base_score"),
        (F.col("model") + added).alias("score"))
