"""Relational TF-IDF (V1, V2, V8) and sparse cosine similarity.

A document-term matrix is a long table ``(doc, term, weight)``; fitting the
vocabulary is one aggregate (document frequency and corpus count per term),
never a driver-side collection.  Semantics follow the common
``TfidfVectorizer`` defaults: lower-case, word tokens of 2+ word characters,
stop words removed before n-grams, ``max_df``/``min_df`` as a share (float)
or an absolute count (int), ``max_features`` by corpus count (ties by term),
smooth idf ``ln((1+n)/(1+df)) + 1``, L2-normalised rows.
"""

from __future__ import annotations

import os
import zipfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.aggregates import attach_one_row
from larder.operators.joins import size_checked_broadcast
from larder.operators.topk import nearest_rows, packed_rows, similar_rows
from larder.session import cut_lineage, give_back

# Maximal runs of 2+ word characters (letters, numbers, underscore) — the
# tokens of ``\b\w\w+\b`` with Python's notion of a word character.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def word_tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(WORD_PATTERN), 0)


def kept_tokens(text, stop_words: Iterable[str] | None = None) -> Column:
    """Word tokens without the stop words, which are looked up in a hash set."""
    toks = word_tokens(text)
    stops = sorted(set(stop_words or ()))
    return F.filter(toks, lambda w: ~w.isin(stops)) if stops else toks


def with_ngrams(tokens: Column, ngram_range: tuple[int, int]) -> Column:
    """Word n-grams for n in the range, joined by one space."""
    lo, hi = ngram_range
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(tokens)
        else:
            m = F.size(tokens) - n + 1
            parts.append(F.when(m > 0, F.transform(
                F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
                lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def term_counts(docs: DataFrame, key: str, text: str, ngram_range=(1, 1),
                stop_words: Iterable[str] | None = None) -> DataFrame:
    """(key, term, tf).  The partial aggregate runs map-side where every token
    of a document already sits, so only distinct (doc, term) pairs shuffle."""
    toks = kept_tokens(text, stop_words)
    terms = with_ngrams(toks, ngram_range)
    return (docs.select(key, F.explode(terms).alias("term"))
            .groupBy(key, "term").agg(F.count(F.lit(1)).cast("long").alias("tf")))


def fit_vocabulary(tf: DataFrame, n_docs: DataFrame, key: str, max_df: float | int = 1.0,
                   min_df: float | int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, ctf, idf[, idx]) for the kept vocabulary.

    ``n_docs`` is a one-row DataFrame with column ``n``.  ``idx`` (alphabetical
    position, the feature index) is only produced when ``max_features`` bounds
    the vocabulary, since it needs one global ordering."""
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("df"), F.sum("tf").cast("long").alias("ctf"))
    stats = attach_one_row(stats, n_docs)
    max_c = F.lit(float(max_df)) if isinstance(max_df, int) and not isinstance(max_df, bool) else F.col("n") * max_df
    min_c = F.lit(float(min_df)) if isinstance(min_df, int) and not isinstance(min_df, bool) else F.col("n") * min_df
    kept = stats.where((F.col("df") <= max_c) & (F.col("df") >= min_c))
    if max_features:
        kept = kept.orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)
    vocab = kept.withColumn("idf", F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).drop("n")
    if max_features:
        vocab = vocab.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("long"))
    return vocab


@lru_cache
def english_stop_words() -> tuple[str, ...]:
    """Spark's own English list (the default of ``StopWordsRemover``), read
    from Spark's jar, so that queries can be listed without a session."""
    home = Path(os.environ.get("SPARK_HOME") or Path(pyspark.__file__).parent)
    for jar in (home / "jars").glob("spark-mllib_*.jar"):
        with zipfile.ZipFile(jar) as archive:
            return tuple(archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split())
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def tfidf(docs: DataFrame, key: str, text: str, max_df: float | int = 1.0, min_df: float | int = 1,
          max_features: int | None = None, ngram_range=(1, 1), stop_words: Iterable[str] | None = None,
          vocab_broadcast_rows: int = 200_000, with_df: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return (weights(key, term, weight[, df]), vocabulary).

    The vocabulary is broadcast into the term join only when its size is
    bounded (``max_features`` <= ``vocab_broadcast_rows``) or measured;
    otherwise the join is a shuffle join on term, where AQE splits the hot
    terms."""
    # The term counts feed both the vocabulary fit and the weights: keep one
    # materialised copy instead of tokenising the corpus twice.
    tf = cut_lineage(term_counts(docs, key, text, ngram_range, stop_words))
    n_docs = docs.agg(F.count(F.lit(1)).cast("long").alias("n"))
    vocab = fit_vocabulary(tf, n_docs, key, max_df, min_df, max_features)
    v = vocab.select("term", "idf", *["df"] * with_df)
    v = F.broadcast(v) if max_features and max_features <= vocab_broadcast_rows else size_checked_broadcast(v)
    # The counts are many times the bytes of their file, by which a planner would broadcast them.
    w = tf.hint("merge").join(v, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    weights = w.select(key, "term", (F.col("w") / norm).alias("weight"), *["df"] * with_df)
    return weights, vocab


#: Most terms of two documents or more whose frequencies a task looks up in memory (12 bytes each).
HELD_TERMS = 8_000_000


def packed_tfidf(docs: DataFrame, key: str, text: str, max_df: float = 1.0) -> DataFrame:
    """(key, t, v): the weights of ``tfidf`` as packed rows (64-bit term hashes,
    the rarest first, and weights), without rows that keep no term.

    No row per document and term is stored or shuffled: the text is cut into
    words again where they are weighed, and the frequencies of terms that two
    documents or more share go to all tasks, if ``HELD_TERMS`` of them at most.
    A larger vocabulary is joined by shuffles."""
    docs = docs.select(key, text)
    hashes = F.transform(word_tokens(text), lambda w: F.xxhash64(w))
    repeated = not docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if repeated:
        docs = docs.repartition(key)
        terms = docs.select(key, F.explode(hashes).alias("t")).distinct()
    else:
        terms = docs.select(F.explode(F.array_distinct(hashes)).alias("t"))
    n = docs.count()
    shared = cut_lineage(terms.groupBy("t").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1"))
    if shared.count() > HELD_TERMS:
        w, _ = tfidf(docs, key, text, max_df=max_df, with_df=True)
        return packed_rows(w, key).withColumnRenamed("k", key)
    found = shared.toArrow()
    known, df = (found.column(c).to_numpy() for c in ("t", "df"))
    order = np.argsort(known)
    held = docs.sparkSession.sparkContext.broadcast((known[order], df[order].astype(np.int32)))
    names = [key, "t", "v"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = held.value
        own = None  # a key whose rows may go on in the next batch, and its words

        def rows(keys: pa.Array, words: list[np.ndarray]) -> pa.RecordBatch:
            each = [np.unique(w, return_counts=True) for w in words]
            t, tf = np.concatenate([x[0] for x in each]), np.concatenate([x[1] for x in each])
            row = np.repeat(np.arange(len(each)), [len(x[0]) for x in each])
            at = np.minimum(np.searchsorted(known, t), max(len(known) - 1, 0))
            often = np.where(known[at] == t, df[at], 1) if len(known) else np.ones(len(t), np.int32)
            keep = (often <= n * max_df) & np.asarray(keys.is_valid())[row]
            t, tf, row, often = t[keep], tf[keep], row[keep], often[keep]
            order = np.lexsort((t, often, row))
            t, tf, row, often = t[order], tf[order], row[order], often[order]
            w = tf * (np.log((1.0 + n) / (1.0 + often)) + 1.0)
            w /= np.sqrt(np.bincount(row, weights=w * w, minlength=len(each)))[row]
            size = np.bincount(row, minlength=len(each))
            has = np.flatnonzero(size)
            ends = pa.array(np.concatenate([[0], np.cumsum(size[has])]), pa.int32())
            return pa.RecordBatch.from_arrays([keys.take(pa.array(has)), pa.ListArray.from_arrays(ends, pa.array(t)),
                                               pa.ListArray.from_arrays(ends, pa.array(w))], names=names)

        for whole in batches:
            for lo in range(0, whole.num_rows, 1_000):
                batch = whole.slice(lo, 1_000)
                keys, column = batch.column(0), batch.column(1)
                ends = np.cumsum(np.diff(np.asarray(column.offsets)))
                words = np.split(np.asarray(column.flatten()), ends[:-1])
                if repeated:
                    k = keys.to_pylist()
                    if own is not None and k[0] == own[0].to_pylist()[0]:
                        words[0] = np.concatenate([own[1], words[0]])
                    elif own is not None:
                        yield rows(own[0], [own[1]])
                    first = [i for i in range(len(k)) if i == 0 or k[i] != k[i - 1]]
                    words = [np.concatenate(words[i:j]) for i, j in zip(first, [*first[1:], len(k)], strict=True)]
                    keys = keys.take(pa.array(first))
                    own = keys.slice(len(first) - 1), words[-1]
                    keys, words = keys.slice(0, len(first) - 1), words[:-1]
                if words:
                    yield rows(keys, words)
        if own is not None:
            yield rows(own[0], [own[1]])
        give_back()

    ready = docs.sortWithinPartitions(key) if repeated else docs
    return ready.select(key, hashes.alias("words")).mapInArrow(weigh, f"{key} {docs.schema[key].dataType.simpleString()}, t array<bigint>, v array<double>")


def mirror_pairs(half: DataFrame, value: str) -> DataFrame:
    """Both directions of each (a < b) pair from one pass (no self-union)."""
    both = F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")),
                             F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return half.select(both.alias("p"), value).select("p.a", "p.b", value)


def _ranked(pairs: DataFrame, key: str, k: int) -> DataFrame:
    # Rank on the similarity rounded to 9 places so float summation order
    # cannot reorder exact ties (duplicate documents).
    w = Window.partitionBy("a").orderBy(F.desc(F.round("sim", 9)), F.asc("b"))
    return (pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("a").alias(key), F.col("rank").cast("long").alias("rank"),
                    F.col("b").alias(f"similar_{key}"), "sim"))


def cosine_topk(weights: DataFrame, key: str, k: int, least: float) -> DataFrame:
    """J8 + W3: for every document, its ``k`` most similar other documents
    (similarity desc, then key) among those with a cosine of at least
    ``least``; see ``topk.similar_rows``."""
    return _ranked(similar_rows(weights, key, k, least), key, k)


def cosine_topk_of(weights: DataFrame, targets: DataFrame | None, key: str, k: int) -> DataFrame:
    """V6: the ``k`` most similar other documents of the given targets, or of
    all, exact and without a least similarity, see ``topk.nearest_rows``;
    documents that share no term with a target are not listed."""
    return _ranked(nearest_rows(weights, targets, key, k), key, k)


def centroid_top_terms(weights: DataFrame, labels: DataFrame, key: str, label: str, n_terms: int = 10) -> DataFrame:
    """Mean TF-IDF weight per (cluster, term) over all members
    (absent terms count as zero), top ``n_terms`` per cluster."""
    sizes = labels.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    sums = weights.join(labels, key).groupBy(label, "term").agg(F.sum("weight").alias("s"))
    mean = sums.join(sizes, label).select(label, "term", (F.col("s") / F.col("size")).alias("weight"))
    w = Window.partitionBy(label).orderBy(F.desc(F.round("weight", 12)), F.asc("term"))
    return mean.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_terms)


def interpret_clusters(weights: DataFrame, labels: DataFrame, key: str, label: str, name_col: str, n_terms: int = 5,
                       n_samples: int = 5, seed: int = 42) -> DataFrame:
    """C13 + W4 + F19: per cluster its size, its ``n_terms`` strongest terms
    joined by commas, and the names of ``n_samples`` members drawn by hash."""
    size = labels.groupBy(label).agg(F.count(F.lit(1)).cast("long").alias("n_products"))
    top = centroid_top_terms(weights, labels.select(key, label), key, label, n_terms)
    joined = top.groupBy(label).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]),
                                                 ", ").alias("top_terms"))
    order = Window.partitionBy(label).orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))))
    drawn = labels.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n_samples)
    names = F.transform(F.sort_array(F.collect_list(F.struct("_r", F.coalesce(F.col(name_col), F.lit("?")).alias("n")))), lambda x: x["n"])
    samples = drawn.groupBy(label).agg(F.array_join(names, "; ").alias("samples"))
    return size.join(joined, label).join(samples, label)
