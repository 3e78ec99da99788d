"""Operators 10 and 3."""

import gzip
import hashlib
import zlib

import pytest

from larder.llm import url_vocabulary as uv
from larder.llm import warc_normal as wn
from larder.llm.common import work_path
from larder.llm.queries import URL_RULES

URLS = {
    1: ("https://WWW.Example.com/en/casino", "www.example.com", "/en/casino", "www.example.com/en/", "allow"),
    2: ("http://m.example.com/en/x", "m.example.com", "/en/x", "example.com/en/", "block"),
    3: ("http://a.net/es/1?x", "a.net", "/es/1", "net/es/", "block"),
    4: ("http://a.net/de/casino", "a.net", "/de/casino", None, "block"),
    5: ("http://a.net/de/casinos", "a.net", "/de/casinos", None, "allow"),
    6: ("http://win.a.net/free#x", "win.a.net", "/free", None, "block"),
    7: ("http://win.a.net/win/win", "win.a.net", "/win/win", None, "allow"),
    8: ("http://b.com?x", "b.com", "", None, "allow"),
    9: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    10: (None, "", "", None, "allow"),
    11: ("xxx", "", "", None, "block"),
    12: ("", "", "", None, "allow"),
    13: ("http://a.org/p?u=http://c.com/casino", "a.org", "/p", None, "block"),
    14: ("HTTP://A.ORG/ADS-TRACK", "a.org", "/ADS-TRACK", None, "block"),
}


def test_urls(spark):
    df = spark.createDataFrame([(k, v[0], "x", 1) for k, v in URLS.items()] + [(None, "http://q.com/", "x", 1)],
                               "page_id long, url string, host string, verdict int").repartition(3)
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uv.judge_urls(df, rules=URL_RULES).collect()}
    assert out.pop(None) == ("q.com", "/", "com/", "allow")
    assert out == {k: v[1:] for k, v in URLS.items()}
    assert uv.judge_urls(df.limit(0), rules=URL_RULES).count() == 0


def test_weights_and_threshold(spark):
    words = uv.Vocabulary(strict=("bad",), soft={"half": 1, "most": 2}, threshold=3)
    df = spark.createDataFrame([(1, "http://x.y/half-most"), (2, "http://x.y/half/half"), (3, "http://x.y/bad"), (4, "http://x.y/abad")],
                               "page_id long, url string")
    out = {r.page_id: (r.verdict, r.strict_hits, r.soft_hits, r.soft_weight) for r in uv.judge_urls(df, vocabulary=words).collect()}
    assert out == {1: ("block", 0, 2, 3), 2: ("allow", 0, 1, 1), 3: ("block", 1, 0, 0), 4: ("allow", 0, 0, 0)}


def test_shipped_vocabulary(spark):
    words = uv.Vocabulary.read()
    assert max(words.soft.values()) < words.threshold and len(set(words.soft.values())) == 3
    assert not set(words.strict) & set(words.soft)
    languages = {line.split("\t")[1] for line in uv.TERMS.read_text().splitlines() if not line.startswith("#")}
    assert languages == {"en", "de", "es", "fr"}
    only = uv.Vocabulary.read(languages=["de"])
    assert "billig" in only.soft and "cheap" not in only.soft
    urls = {1: "http://a.b/billig-kredit", 2: "http://a.b/promo/sale", 3: "http://a.b/promo/sale/deal/click", 4: "http://a.b/poker",
            5: "http://a.b/poker-farm", 6: "http://a.b/paris-sportifs?x=offre", 7: "http://a.b/xparis-sportifs/offre"}
    df = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    out = {r.page_id: (r.verdict, r.soft_hits, r.soft_weight) for r in uv.judge_urls(df).collect()}
    assert out == {1: ("block", 2, 4), 2: ("allow", 2, 2), 3: ("block", 4, 4), 4: ("allow", 1, 3), 5: ("block", 2, 4),
                   6: ("block", 2, 4), 7: ("allow", 1, 1)}


def test_very_long_url(spark):
    # Terms at both ends of 2,000,000 characters; 400,000 times a term without a boundary behind it.
    rows = [(1, "http://a.b/free/" + "z" * 2_000_000 + "/win"), (2, "http://a.b/" + "casinox" * 400_000)]
    out = {r.page_id: (r.verdict, r.strict_hits, r.soft_hits) for r in uv.judge_urls(
        spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert out == {1: ("block", 0, 2), 2: ("allow", 0, 0)}


def test_vocabulary_file(tmp_path):
    file = tmp_path / "terms.tsv"
    file.write_text("# note\nlow\ten\t1\nlow\tde\t3\nhard\ten\t2\nhard\tde\tstrict\n\n")
    assert uv.Vocabulary.read(file) == uv.Vocabulary(("hard",), {"low": 3})
    assert uv.Vocabulary.read(file, ["en"], 9) == uv.Vocabulary((), {"hard": 2, "low": 1}, 9)
    for bad in ({"Low": 1}, {"low": 0}, {"": 1}):
        with pytest.raises(ValueError):
            uv.Vocabulary((), bad)


def pages(spark):
    same, small = "<p>" + "same " * 50, "tiny"
    rows = [(5, "http://a/1", same), (2, "http://a/2", same), (9, None, same), (1, "http://b/ü x", small), (3, "u", small),
            (4, "u", None), (6, "u", ""), (7, "u", "é" * 60000), (8, "u", "é" * 60000), (None, "n", same), (2, "again", same)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, archive string").repartition(3)


def test_warc_round_trip(spark):
    rows, df = pages(spark)
    out = wn.round_trip(df).collect()
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        first = min(p for p, _, h in rows if p is not None and (h or "").encode() == body)
        again = len(body) >= 100 and page is not None and page != first
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == sorted(want, key=str)
    assert wn.round_trip(df.limit(0)).count() == 0


def test_every_record_is_a_member_at_its_offset(spark):
    _, df = pages(spark)
    whole, single = work_path(spark, "w"), work_path(spark, "s")
    listed = wn.write_archives(df, whole)
    made = wn.normalise(listed, single)
    assert sum(r.records for r in made.collect()) == df.count()
    for a, b in zip(sorted(r.archive for r in listed.collect()), sorted(r.archive for r in made.collect()), strict=True):
        raw = [wn.file_system(p)[0].open_input_stream(wn.file_system(p)[1], compression=None).read() for p in (a, b)]
        one = zlib.decompressobj(wn.GZIP)
        assert gzip.decompress(raw[0]) == one.decompress(raw[0]) == gzip.decompress(raw[1])
        assert not one.unused_data  # a single stream
    full = wn.read_records(spark, single, payloads=True).collect()
    for r in full:
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert {r.url for r in full} >= {"http://b/ü%20x", None}


def test_normaliser_reads_members_and_refuses_damage(tmp_path):
    records = [wn.record_bytes(n, "u", b"x" * 300 * n, hashlib.sha256(b"x" * 300 * n).hexdigest(), 300 * n, None) for n in range(5)]
    mixed = gzip.compress(b"".join(records[:2])) + gzip.compress(b"".join(records[2:]))
    (tmp_path / "a.warc.gz").write_bytes(mixed)
    assert wn.normalise_file(str(tmp_path / "a.warc.gz"), str(tmp_path / "out/a.warc.gz")) == 5
    assert gzip.decompress((tmp_path / "out/a.warc.gz").read_bytes()) == b"".join(records)
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(b"".join(records))[:-20])
    with pytest.raises((ValueError, zlib.error)):
        wn.normalise_file(str(tmp_path / "cut.warc.gz"), str(tmp_path / "out/cut.warc.gz"))
    (tmp_path / "bad.warc.gz").write_bytes(gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError, match="not a WARC"):
        wn.normalise_file(str(tmp_path / "bad.warc.gz"), str(tmp_path / "out/bad.warc.gz"))
    (tmp_path / "none.warc.gz").write_bytes(gzip.compress(b""))
    assert wn.normalise_file(str(tmp_path / "none.warc.gz"), str(tmp_path / "out/none.warc.gz")) == 0
