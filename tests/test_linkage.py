"""Agglomerative clustering against the greedy method on the whole matrix."""

import itertools
import math
import random

import pytest

from larder.operators import linkage as L

FAR = 1.5


def greedy(n, edges, kind):
    """[(members, distance)] of all merges below FAR, nearest pair first."""
    near = {frozenset(p): d for *p, d in edges}
    d = lambda i, j: near.get(frozenset((i, j)), FAR)
    clusters, out = [frozenset([i]) for i in range(n)], []

    def between(a, b):
        every = [d(i, j) for i in a for j in b]
        return {"single": min, "complete": max, "average": lambda v: sum(v) / len(v)}[kind](every)

    while len(clusters) > 1:
        dist, _, _, a, b = min(((round(between(a, b), 9), min(min(a), min(b)), max(min(a), min(b)), a, b)
                                for a, b in itertools.combinations(clusters, 2)), key=lambda x: x[:3])
        if dist >= FAR - 1e-9:
            break
        clusters = [c for c in clusters if c not in (a, b)] + [a | b]
        out.append((a | b, dist))
    return out, clusters


def graph(n, share, seed):
    rng = random.Random(seed)
    points = [(rng.random(), rng.random()) for _ in range(n)]
    return [(i, j, math.dist(points[i], points[j])) for i, j in itertools.combinations(range(n), 2)
            if math.dist(points[i], points[j]) < share]


def members(merges):
    """[(members, distance)] of dendrogram rows."""
    own, out = {}, []
    for r in sorted(merges, key=lambda r: r.turn):
        a, b = own.pop(r.a, frozenset([r.a])), own.pop(r.b, frozenset([r.b]))
        own[r.a] = a | b
        assert r.size == len(a | b) and min(a | b) == r.a
        out.append((a | b, round(r.distance, 9)))
    return out


class _Runs(dict):
    def __missing__(self, n):
        edges = graph(n, {16: 0.45, 20: 2.0}[n], n)
        frame = self.spark.createDataFrame([(j, i, d) if (i + j) % 2 else (i, j, d) for i, j, d in edges], "a int, b int, distance double")
        self[n] = edges, L.dendrogram(frame, FAR)
        return self[n]


@pytest.fixture(scope="module")
def runs(spark):
    out = _Runs()
    out.spark = spark
    return out


@pytest.mark.parametrize("n", [16, 20])
@pytest.mark.parametrize("kind", L.LINKAGES)
def test_merges_are_the_greedy_ones(runs, n, kind):
    edges, merges = runs[n]
    got = members(merges.where(merges.linkage == kind).collect())
    want, _ = greedy(n, edges, kind)
    assert {m for m, _ in got} == {m for m, _ in want}
    near = dict(want)
    assert all(d == pytest.approx(near[m], abs=1e-7) for m, d in got)


def test_rounds_are_few(runs):
    assert runs[20][1].agg({"turn": "max"}).first()[0] < 20


@pytest.mark.parametrize("n", [16, 20])
def test_cuts(spark, runs, n):
    edges, merges = runs[n]
    nodes = spark.createDataFrame([(i,) for i in range(n + 1)], "id int")  # one row without any edge
    got = {}
    for r in L.cut_labels(nodes, merges, "id", (2, 9)).collect():
        got.setdefault((r.linkage, r.k), {}).setdefault(r.cluster, set()).add(r.id)
    for kind in L.LINKAGES:
        want, top = greedy(n, edges, kind)
        top = [*top, frozenset([n])]
        for k in range(2, 10):
            if len(top) > k:  # the largest stay, the others go together
                top_k = sorted(top, key=lambda c: (-len(c), min(c)))
                parts = {*top_k[:k - 1], frozenset().union(*top_k[k - 1:])}
            else:
                parts = {frozenset([i]) for i in range(n + 1)}
                for m, _ in sorted(want, key=lambda x: x[1])[:n + 1 - k]:
                    parts = {p for p in parts if not p <= m} | {m}
            assert {frozenset(c) for c in got[kind, k].values()} == parts
            assert all(min(c) == name for name, c in got[kind, k].items())


def test_no_edges(spark):
    none = spark.createDataFrame([], "a int, b int, distance double")
    merges = L.dendrogram(none, FAR)
    assert merges.collect() == []
    assert L.cut_labels(spark.createDataFrame([(1,)], "id int"), merges, "id").collect() == []
    odd = spark.createDataFrame([(1, 1, 0.1), (1, 2, 2.0), (3, None, 0.1), (4, 5, 0.5), (5, 4, 0.4)], "a int, b int, distance double")
    assert [(r.a, r.b, r.distance) for r in L.dendrogram(odd, FAR, ["single"]).collect()] == [(4, 5, 0.4)]
    with pytest.raises(ValueError):
        L.dendrogram(none, FAR, ["ward"])
