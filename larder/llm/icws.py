"""Near-duplicate detection by weighted sampling (operator 9).

A text is the weighted set of its shingles, tf times idf.  Improved consistent
weighted sampling draws from it, for each of ``BANDS * ROWS`` hash functions, a
shingle and a level such that two texts draw the same with a probability equal
to their weighted Jaccard similarity.  Texts that agree in all rows of a band
are candidates, a weaker agreement of the whole signature drops most false
ones, and the exact weighted Jaccard similarity decides.  Classes are the
connected components of the links.

Document frequencies are counted over all documents by hashed shingle, in a
table of fixed size: a shingle shares its slot with about one in ``SLOTS`` of
all others and takes on their documents.  So the more shingles a table has, the
smaller the idf of a rare one, and the nearer the weights are to plain tf.

No group is paired off as a whole.  Texts of the same words are one node.  A
bucket of up to ``PAIRED`` nodes is paired off; in a larger one all nodes are
held against a leader, which differs between the bands of a text.  Nodes that
are not in their leader's component by then are left over.  They are compared
with all nodes they share a bucket with, in blocks, without writing pairs:
nodes that are in one component already are skipped, a bound on what a pair
can share rules most others out, and only links that join two components leave
a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored
from larder.llm.shingles import mix, sequence_key, shingle_hashes, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
SLOTS = 1 << 16
#: How much the idf adds to a weight at most.  What a large group of near
#: copies shares is frequent, and with the full idf the group would fall apart
#: over the few rare shingles in which its texts differ.
DAMPING = 0.25
#: Nodes of a bucket that are held against each other directly.
PAIRED = 24
#: Agreeing draws, as a share of all, below which a pair cannot be similar
#: (over five standard deviations under the similarity that is asked for).
AGREEING = 0.55
#: Nodes of a block, where nodes that are left over meet the others of their buckets.
BLOCK_NODES = 512
CHUNK = 512
SLICE_TEXTS = 64


def _quantiles(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at n midpoints."""
    p, x = (np.arange(n) + 0.5) / n, np.linspace(-9, 4, 4001)
    cdf = 1 - (1 + np.exp(x)) * np.exp(-np.exp(x))
    return np.exp(np.interp(p, cdf, x))


class Sampler:
    """Draws of ``BANDS * ROWS`` hash functions from a weighted set."""

    def __init__(self, draws: int) -> None:
        # 20, 12 and 24 bits of a hash choose c, r and beta.
        self.log_c = np.log(_quantiles(1 << 20)).astype(np.float32)
        self.r = _quantiles(1 << 12).astype(np.float32)
        self.factors = mix(np.arange(1, draws + 1, dtype=np.uint64)) | np.uint64(1)

    def draw(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value per hash function: the shingle drawn and its level."""
        best = np.full(len(self.factors), np.inf, dtype=np.float32)
        value = np.zeros(len(self.factors), dtype=np.uint64)
        columns = np.arange(len(self.factors))
        for at in range(0, len(shingles), CHUNK):
            own, log_w = shingles[at:at + CHUNK], np.log(weights[at:at + CHUNK]).astype(np.float32)[:, None]
            z = own[:, None] * self.factors
            z ^= z >> np.uint64(29)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            r = self.r[(z >> np.uint64(32)) & np.uint64(0xFFF)]
            beta = (z & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2.0 ** -24)
            level = np.floor(log_w / r + beta)
            log_a = self.log_c[z >> np.uint64(44)] - r * (level - beta + 1)
            row = log_a.argmin(axis=0)
            least = log_a[row, columns]
            better = least < best
            best = np.where(better, least, best)
            drawn = mix(own[row] ^ mix(level[row, columns].astype(np.int64).view(np.uint64) + np.uint64(77)))
            value = np.where(better, drawn, value)
        return value


_SAMPLERS: dict[int, Sampler] = {}


def sampler(draws: int) -> Sampler:
    if draws not in _SAMPLERS:
        _SAMPLERS[draws] = Sampler(draws)
    return _SAMPLERS[draws]


def slot_of(shingles: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return (shingles >> np.uint64(40)).astype(np.int64) % slots


def idf_table(counts: dict[int, int], n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """1 + DAMPING * smoothed idf as a share of its maximum, per slot."""
    df = np.zeros(slots)
    for slot, n in counts.items():
        df[slot] = n
    top = np.log(1 + max(n_docs, 1))
    return 1 + DAMPING * np.clip(np.log((1 + n_docs) / (1 + df)) / top, 0, 1)


def weigh(shingles: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their tf * idf."""
    distinct, tf = np.unique(shingles, return_counts=True)
    return distinct, tf * idf[slot_of(distinct, len(idf))]


def weighted_jaccard(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Of two multisets of shingles."""
    (sa, wa), (sb, wb) = weigh(a, idf), weigh(b, idf)
    _, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    low = np.minimum(wa[ia], wb[ib]).sum()
    both = wa.sum() + wb.sum() - low
    return float(low / both) if both else 0.0


def _texts(batches: Iterator[pa.RecordBatch], name: str):
    """(rows, word hashes of each) in small slices."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_TEXTS):
            part = batch.slice(at, SLICE_TEXTS)
            yield part, word_hashes([t or "" for t in part.column(name).to_pylist()])


def _frequencies(shingle: int, slots: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, dtype=np.int64)
        for _, words in _texts(batches, "text"):
            for w in words:
                if len(w):
                    # Two shingles of one text in the same slot count once.
                    total[np.unique(slot_of(shingle_hashes(w, shingle), slots))] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])
    return count


def document_frequencies(docs: DataFrame, text_col: str, shingle: int = SHINGLE, slots: int = SLOTS) -> np.ndarray:
    """The idf of every slot; the driver receives at most ``slots`` sums."""
    given = docs.select(F.col(text_col).alias("text"))
    counts = given.mapInArrow(_frequencies(shingle, slots), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    return idf_table({r.slot: r.n for r in counts.collect()}, docs.count(), slots)


def _signatures(sent, shingle: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, draw = sent.value, sampler(bands * rows).draw
        place = np.arange(bands, dtype=np.uint64)
        for part, words in _texts(batches, "text"):
            raw = part.column("raw").to_pylist()
            keys, banded, prints = [], [], []
            for w, own in zip(words, raw, strict=True):
                if not len(w):  # only texts equal to it are its copies
                    keys.append((own, -1))
                    banded.append([])
                    prints.append(b"")
                    continue
                keys.append(sequence_key(w))
                value = draw(*weigh(shingle_hashes(w, shingle), idf))
                h = place + np.uint64(1)
                for r in range(rows):
                    h = mix(h * np.uint64(31) + value[r::rows])
                banded.append(h.view(np.int64))
                prints.append((value & np.uint64(0xFFFF)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("raw"), *(pa.array(k, pa.int64()) for k in zip(*keys, strict=True)),
                 pa.array(banded, pa.list_(pa.int64())), pa.array(prints, pa.binary())],
                names=["doc_id", "raw", "k1", "k2", "bands", "sig"])
    return sign


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            near = (a == b).mean(axis=1) >= AGREEING
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _verified(sent, least: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [[np.asarray(x.values).view(np.uint64) for x in part.column(c)] for c in ("fa", "fb")]
                likeness = [weighted_jaccard(x, y, idf) for x, y in zip(*sets, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(likeness, pa.float64())], names=["a", "b", "similarity"]
                ).filter(pa.array([s >= least for s in likeness], pa.bool_()))
    return verify


def _features(shingle: int):
    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words in _texts(batches, "text"):
            found = [np.sort(shingle_hashes(w, shingle)).view(np.int64) for w in words]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "f"])
    return shingled


class _Pairs:
    """Turns candidate pairs into verified links."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, idf, shingle: int, similarity: float) -> None:
        self.docs, self.nodes, self.shingle, self.similarity = docs, nodes, shingle, similarity
        self.sent = docs.sparkSession.sparkContext.broadcast(idf)

    def features(self, nodes: DataFrame) -> DataFrame:
        """(node, f: its sorted shingles) of some nodes, stored."""
        wanted = stored(nodes.join(self.nodes.select("node", "row_id", "raw"), "node"), "near-nodes")
        # Always by shuffle: few nodes would be broadcast and many not, so that cost would jump with the size.
        texts = self.docs.join(wanted.hint("merge"), ["row_id", "raw"]).select("node", "text").dropDuplicates(["node"])
        return stored(texts.mapInArrow(_features(self.shingle), "node long, f array<long>"), "near-sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b, similarity) of the similar ones among distinct pairs, stored."""
        sig = self.nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
        other = sig.select(F.col("a").alias("b"), F.col("sa").alias("sb"))
        near = stored(pairs.join(sig, "a").join(other, "b").select("a", "b", "sa", "sb")
                      .mapInArrow(_agreement, "a long, b long"), "near-pairs")
        ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = self.features(ends)
        left = sets.select(F.col("node").alias("a"), F.col("f").alias("fa"))
        right = sets.select(F.col("node").alias("b"), F.col("f").alias("fb"))
        both = near.join(left, "a").join(right, "b").select("a", "b", "fa", "fb")
        return stored(both.mapInArrow(_verified(self.sent, self.similarity), "a long, b long, similarity double"), "links")


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).filter("a < b").distinct()


def _sized(members: DataFrame) -> DataFrame:
    """(key, node, leader, n) of the buckets with two members or more."""
    sizes = stored(members.groupBy("key").agg(F.count("*").alias("n"),
                                              F.min(F.struct(F.xxhash64("node", "key"), "node")).alias("lead"))
                   .filter("n > 1").select("key", "n", F.col("lead.node").alias("leader")), "buckets")
    return stored(members.join(sizes, "key"), "bucketed")


def _compared(sent, least: float):
    """Links that join two components, between the left-over nodes (``side``
    0) and the nodes (1) of one pair of blocks."""
    def compare(key, part):
        import pandas as pd

        idf = sent.value
        side = part["side"].to_numpy()
        sig = np.frombuffer(b"".join(part["sig"]), "<u2").reshape(len(part), -1)
        nodes, roots = part["node"].to_numpy(), part["root"].to_numpy().copy()
        sets = [weigh(np.asarray(f).view(np.uint64), idf) for f in part["f"]]
        total = np.array([w.sum() for _, w in sets])
        # What only this text holds here it shares with none of the others.
        _, once = np.unique(nodes, return_index=True)  # a node may stand on both sides
        every, times = np.unique(np.concatenate([sets[i][0] for i in once]), return_counts=True)
        common = every[times > 1]
        most = np.array([w[np.isin(x, common, assume_unique=True)].sum() for x, w in sets])
        ours, theirs = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = []
        for i in ours:
            shared = np.minimum(most[i], most[theirs])
            hope = shared / np.maximum(total[i] + total[theirs] - shared, 1e-12) >= least - 1e-9
            hope &= (roots[theirs] != roots[i]) & ((sig[theirs] == sig[i]).mean(axis=1) >= AGREEING)
            for j in theirs[hope]:
                if roots[j] == roots[i]:
                    continue
                (sa, wa), (sb, wb) = sets[i], sets[j]
                _, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
                low = np.minimum(wa[ia], wb[ib]).sum()
                likeness = low / (total[i] + total[j] - low)
                if likeness >= least:
                    found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j]), likeness))
                    roots[roots == roots[j]] = roots[i]
        return pd.DataFrame(found, columns=["a", "b", "similarity"])
    return compare


def _left_over_links(pairs: _Pairs, large: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Compares the nodes of large buckets that are not in their leader's
    component with all nodes they share such a bucket with."""
    leads = roots.select(F.col("node").alias("leader"), F.col("root").alias("leads"))
    rooted = large.join(roots, "node", "left").join(leads, "leader", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"), F.coalesce("leads", "leader").alias("g"))
    rooted = stored(rooted, "rooted")
    over = rooted.filter(F.col("root") != F.col("g"))
    if over.isEmpty():
        return None
    # Buckets whose leaders belong together form one group, so that no pair is compared in each band anew.
    members = rooted.join(over.select("g").distinct(), "g")
    nodes = stored(members.groupBy("g", "node", "root").agg(F.max(F.col("root") != F.col("g")).alias("open")), "left-over-nodes")
    sizes = nodes.groupBy("g").agg(F.ceil(F.sum(F.col("open").cast("long")) / BLOCK_NODES).alias("us"),
                                   F.ceil(F.count("*") / BLOCK_NODES).alias("ms"))
    filled = (nodes.join(pairs.features(nodes.select("node").distinct()), "node").join(pairs.nodes.select("node", "sig"), "node")
              .join(sizes, "g"))
    u, m = F.pmod(F.xxhash64("node"), "us"), F.pmod(F.xxhash64("node"), "ms")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    columns = ["g", "node", "root", "sig", "f"]
    mine = filled.filter("open").select(*columns, F.lit(0).alias("side"), u.alias("ub"), F.explode(upto("ms")).alias("mb"))
    others = filled.select(*columns, F.lit(1).alias("side"), F.explode(upto("us")).alias("ub"), m.alias("mb"))
    # Dealt by block: what is dealt by group already would stay one task a group.
    dealt = mine.unionByName(others).repartition("g", "ub", "mb")
    compared = dealt.groupBy("g", "ub", "mb").applyInPandas(
        _compared(pairs.sent, pairs.similarity), "a long, b long, similarity double")
    return stored(compared, "left-over-links")


def similar_components(docs: DataFrame, nodes: DataFrame, idf: np.ndarray, shingle: int, similarity: float) -> DataFrame:
    """(node, root) of the nodes that are similar to another one: all links of
    the small buckets, and of the large ones as many as join all that belongs
    together."""
    pairs = _Pairs(docs, nodes, idf, shingle, similarity)
    sized = _sized(nodes.select("node", F.explode("bands").alias("key")))
    small = sized.filter(F.col("n") <= PAIRED).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("own"))
    spread = small.select("own", F.posexplode("own").alias("at", "a"))
    paired = spread.select("a", F.explode(F.slice("own", F.col("at") + 2, F.size("own"))).alias("b"))
    large = sized.filter(F.col("n") > PAIRED)
    roots = stored(components(pairs.links(paired.unionByName(_ordered(large, "node", "leader")).distinct())), "roots")
    more = _left_over_links(pairs, large, roots)
    if more is None or more.isEmpty():
        return roots
    # The new links join components: only their roots are joined up again.
    ends = more
    for end in ("a", "b"):
        own = roots.select(F.col("node").alias(end), F.col("root").alias("r"))
        ends = ends.join(own, end, "left").withColumn(f"r{end}", F.coalesce("r", end)).drop("r")
    joined = stored(components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "joined-roots")
    onto = joined.select(F.col("node").alias("root"), F.col("root").alias("onto"))
    single = joined.join(roots.select("node"), "node", "left_anti")  # nodes that had no link before
    return roots.join(onto, "root", "left").select("node", F.coalesce("onto", "root").alias("root")).unionByName(single)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes with links: root is the component's least
    node.  Large and small stars take turns until every edge leads to a root;
    the edges stay in the shared folder and never reach the driver."""
    edges = stored(_ordered(links, "a", "b").select(F.col("b").alias("u"), F.col("a").alias("v")), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        edges = stored(small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                      F.struct("u", F.col("m").alias("v")))).alias("e"))
                       .select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        roots = edges.select("v").distinct()
        # Done when each node has one edge, to a node that has none to a smaller one.
        uneven = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u").unionByName(
            edges.select("u").join(roots, F.col("u") == F.col("v"), "left_semi"))
        if uneven.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds doc_id, row_id (without nulls) and raw, the text's hash."""
    doc = F.col(id_col).cast("long")
    return df.withColumns({"doc_id": doc, "row_id": F.coalesce(doc, F.lit(-(2**63))),
                           "raw": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, kept, raw.

    Two texts are linked when the weighted Jaccard similarity of their
    shingles is at least ``similarity``; a text of fewer words is one shingle,
    and one without words (null counts as empty) is linked only to equal ones.
    The class's smallest identifier is its class_id, and the first row with it
    is kept (nulls come last).  Repeated rows are copies; an empty table gives
    an empty result; ``raw`` is the text's hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = _keyed(df, id_col, text_col).select("doc_id", "row_id", "raw", text.alias("text"))
    idf = document_frequencies(df, text_col, shingle)
    sent = df.sparkSession.sparkContext.broadcast(idf)
    signed = docs.mapInArrow(_signatures(sent, shingle, bands, rows),
                             "doc_id long, raw long, k1 long, k2 long, bands array<long>, sig binary")
    signed = stored(signed.withColumn("uid", F.monotonically_increasing_id()), "signatures")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    nodes = stored(signed.groupBy("k1", "k2").agg(
        F.min("uid").alias("node"), F.min(order).alias("first"), F.count("*").alias("copies"),
        F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"),
        F.min_by("raw", order).alias("raw"))
        .withColumn("row_id", F.coalesce("first.doc_id", F.lit(-(2**63)))), "nodes")
    found = similar_components(docs, nodes, idf, shingle, similarity)
    roots = stored(nodes.join(found, "node", "left").select(
        "k1", "k2", "first", "copies", F.coalesce("root", "node").alias("root")), "roots")
    classes = stored(roots.groupBy("root").agg(F.min("first").alias("lead"), F.sum("copies").alias("class_size"))
                     .filter("class_size > 1"), "classes")
    named = stored(roots.join(classes, "root").select("k1", "k2", "lead", "class_size"), "named")
    # Rows alone in their class meet no row of ``named``.
    return (signed.select("doc_id", "raw", "k1", "k2", "uid").join(named, ["k1", "k2"], "left")
            .select("doc_id", F.when(F.col("lead").isNull(), F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
                    (F.col("lead").isNull() | (F.col("uid") == F.col("lead.uid"))).alias("kept"), "raw"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that ``near_classes`` keeps, all columns unchanged."""
    names = [f"c{n}_" for n in range(len(df.columns))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(df.columns, names, strict=True)])
    own_id, own_text = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    keys = ["row_id", "raw"]
    kept = near_classes(rows, own_id, own_text, **options).filter("kept").select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("row_id"), "raw")
    left = _keyed(rows, own_id, own_text).join(kept, keys, "left_semi").dropDuplicates(keys)
    return left.select(*[F.col(n).alias(c) for c, n in zip(df.columns, names, strict=True)])
