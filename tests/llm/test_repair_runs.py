"""Operator 11 against trying every period at every place."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np

from larder.llm import queries  # noqa: F401 - registers
from larder.llm import repair_runs as R
from larder.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def brute(w, least=6, periods=4):
    out = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def some_texts(rng):
    texts = []
    for _ in range(rng.randint(1, 6)):
        letters, n, w = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 3, 6, 10, 30, 100, 200]), []
        while len(w) < n:
            w += [rng.randrange(letters) for _ in range(rng.randint(1, 9))] * rng.choice([1, 1, 2, 4, 5, 9])
        texts.append(w[:n])
    return texts + texts[:rng.randint(0, 2)]


def test_random_texts_equal_brute_force():
    rng, found = random.Random(5), 0
    for _ in range(400):
        texts = some_texts(rng)
        want = [brute(t) for t in texts]
        assert R.runs_of(texts) == want
        found += sum(map(len, want))
    assert found > 500


def test_periodic_and_hostile_texts():
    morse = [bin(n).count("1") % 2 for n in range(1 << 13)]  # defeats polynomial hashes modulo 2**64
    fib, more = [0], [0, 1]
    while len(more) < 3000:
        fib, more = more, more + fib
    doubled = morse + [1 - x for x in morse] + morse
    for text in ([7] * 5, [7] * 6, [7] * 4001, [1, 2] * 900 + [1], more, ([0] * 7 + [1]) * 40, ([0, 1] * 5 + [2]) * 30):
        assert R.runs_of([text]) == [brute(text)]
    assert R.runs_of([doubled]) == [[]]


def test_false_hashes_are_found_out(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(R._Words, "equal", lambda self, a, b, n: (self.ids[np.minimum(a, len(self.ids) - 1)] % 2 == self.ids[np.minimum(b, len(self.ids) - 1)] % 2) | (n == 0))
    for _ in range(30):
        for text, runs in zip(texts := some_texts(rng), R.runs_of(texts), strict=True):
            assert all(e >= max(6, 4 * q) and text[s:s + e - q] == text[s + q:s + e] for s, e, q in runs)


def test_grammar_derives_the_texts():
    rng = random.Random(2)
    texts = some_texts(rng) + [[rng.randrange(20) for _ in range(500)]]
    ids = np.array([x for t in texts for x in t])
    g = R.re_pair(ids, np.cumsum([len(t) for t in texts]))
    for rule, at in zip(g.rule.tolist(), g.at.tolist(), strict=True):
        f, size = int(g.first[rule]), int(g.size[rule])
        assert 0 < g.half[rule] < size and ids[f:f + size].tolist() == ids[at:at + size].tolist()


def expected(doc, text):
    """The contract's row, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), 1 if doc is None else zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, e, q in runs for i in range(s + q, s + e)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    text = "".join(f"{s},{e},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc, len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = sorted(tuple(r) for r in QUERIES["op11_repair_runs"](spark, SF).collect())
    assert got == sorted(expected(*r) for r in rows)


def test_rows_of_all_kinds(spark):
    texts = [None, "", " \n\t", "a " * 6, "a " * 5, "x y\x85 " * 9, "a\x0bb\x0ca\rb a b a b a", "la la la la la di da " * 50,
             "one " * 30_000 + "two three " * 30_000, "é" * 10]
    rows = [(n, t) for n, t in enumerate(texts)] + [(None, texts[3]), (3, texts[3]), (None, None)] + [(10 * n, "w v u " * 20) for n in range(30)]
    docs = spark.createDataFrame([(*r, "runs", 5) for r in rows], "doc_id long, text string, runs string, length int").repartition(3)
    got = [tuple(r) for r in R.digest(R.periodic_runs(docs, change=R.planted)).collect()]
    small = [r for r in rows if not r[1] or len(r[1]) < 10_000]
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(
        [repr(expected(*r)) for r in small] + [repr(g) for g in got if g[0] == 8])
    plain = {r.doc_id: r for r in R.periodic_runs(docs).filter("doc_id = 8").collect()}
    assert [tuple(x) for x in plain[8].runs] == [(0, 30_000, 1), (30_000, 60_000, 2)]
    assert R.digest(R.periodic_runs(docs.limit(0))).collect() == []
