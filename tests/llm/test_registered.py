"""The registered queries: SQL where there is some, contracts elsewhere, and
the pipeline against the stages put together by brute force."""

import duckdb
import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from larder.llm import icws, leak_simhash, queries  # noqa: F401 - registers
from larder.llm.registry import ORACLE, QUERIES
from tests_llm_reference import reference_ids

SF = "/root/testdata/sf0.001"


def connection():
    db = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        db.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return db


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = connection().execute(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    ids = {r[0] for r in connection().execute("select doc_id from documents").fetchall()}
    if name.startswith("op7"):
        assert set(got.doc_id) <= ids
    else:
        assert set(got.doc_id) == ids
        assert name.startswith("op1_") or len(got) == len(ids)


def test_ids_of_packing_and_token_files(spark):
    docs = connection().execute("select doc_id, coalesce(text, '') from documents order by doc_id").fetchall()
    pieces = QUERIES["op1_best_fit"](spark, SF).toPandas().sort_values(["doc_id", "piece"])
    ids = reference_ids("byte_bpe_50k.json", [t for _, t in docs], 0)
    for (doc, _), own in zip(docs, ids, strict=True):
        mine = pieces[pieces.doc_id == doc]
        assert mine.length.sum() == len(own)
        for p in mine.itertuples():
            assert p.ids_crc32 == np.uint32(__import__("zlib").crc32(own[p.start:p.start + p.length].tobytes()))
    from test_encode_and_packing import naive

    assert pieces.sequence_id.nunique() == len(naive(pieces.length.tolist(), 2048))


def test_near_classes_of_the_table_equal_brute_force(spark):
    from test_near_dedup import classes_of, idf_of

    rows = connection().execute("select doc_id, text from documents").fetchall()
    got = {r.doc_id: r.class_id for r in QUERIES["op9_near_dedup"](spark, SF).collect()}
    assert got == {d: c for (d, _), c in zip(rows, classes_of(rows, idf_of(rows)), strict=True)}


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from test_exact_dedup import brute
    from test_leaks import brute as leaked
    from test_near_dedup import classes_of, idf_of

    toxic = {r.doc_id for r in QUERIES["op4_toxicity"](spark, SF).collect() if r.predicted}
    rows = [r for r in connection().execute("select doc_id, text from documents").fetchall() if r[0] not in toxic]
    stays = {k for _, k, *_ in brute(rows, "max")}
    rows = [r for r in rows if r[0] in stays]
    rows = [r for r, c in zip(rows, classes_of(rows, idf_of(rows)), strict=True) if r[0] == c]
    items = connection().execute("select item_id, text from benchmark").fetchall()
    index = leak_simhash.ItemIndex(items, 5, 0.8, leak_simhash.RADIUS, leak_simhash.BLOCKS)
    found = {d for d, t in rows if index.search(t)}
    some = [r for r in rows if r[0] in found or r[0] % 25 == 0]  # the slow brute force on a part
    assert {d for d, _ in leaked(some, items)} == found
    rows = [r for r in rows if r[0] not in found]
    out = __spark_entry__.queries()["pipeline"](spark, SF).toPandas()
    assert set(out.doc_id) == {d for d, _ in rows}
    ids = reference_ids("byte_bpe_50k.json", [t or "" for _, t in rows], 0)
    assert out.length.sum() == sum(map(len, ids))
    assert (out.groupby("sequence_id").length.sum() <= 2048).all()
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert icws.SHINGLE == 5 and icws.SIMILARITY == 0.8
