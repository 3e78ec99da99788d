"""The stream with keyed state: late rows, restart, replay, and bounded reads."""

import pathlib

import pytest

from larder.sources.ingest import latest_per_key
from larder.streaming.keyed_state import Table, run_keyed_stream

SCHEMA = "k int, ts int, v string"


@pytest.fixture
def stream(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    landed, ckpt = str(tmp_path / "landed"), str(tmp_path / "ckpt")
    table = Table(spark, str(tmp_path / "table"), "k", ["ts", "v"], schema)

    def land(*batches):
        for b in batches:
            spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(landed)

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        run_keyed_stream(source, table, ckpt)
        return sorted(map(tuple, table.read().collect()), key=str)
    return land, run, table, pathlib.Path(ckpt)


def _want(spark, rows):
    return sorted(map(tuple, latest_per_key(spark.createDataFrame(rows, SCHEMA), "k", ["ts", "v"]).collect()), key=str)


def test_late_rows_restart_and_replay(spark, stream):
    land, run, table, ckpt = stream
    assert table.read().count() == 0 and table.read().columns == ["k", "ts", "v"]
    batches = [[(1, 5, "a"), (2, 1, "b")], [(1, 3, "late"), (3, 9, "c"), (None, 1, "n")], [(2, 7, "d"), (2, 6, "e"), (None, 0, "late")],
               [(1, 5, "b"), (4, None, None)]]
    land(*batches)
    rows = [r for b in batches for r in b]
    assert run() == _want(spark, rows)
    folders = table.folders()
    assert run() == _want(spark, rows) and table.folders() == folders  # restart: nothing new
    # The last batch has run but is not marked as done: it is replayed from the state before it.
    last = max((ckpt / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    assert run() == _want(spark, rows)
    # A late row of a key that was folded away long ago, and a new key.
    more = [(3, 1, "late"), (5, 1, "new")]
    land(more)
    assert run() == _want(spark, rows + more)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_an_unfinished_fold_is_not_read(spark, stream):
    land, run, table, _ = stream
    land([(1, 1, "a"), (2, 1, "b")])
    want = run()
    broken = pathlib.Path(table.path) / "snapshot" / "7"
    spark.createDataFrame([(1, 9, "torn")], SCHEMA).coalesce(1).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert sorted(map(tuple, table.read().collect()), key=str) == want


def test_reads_do_not_grow_with_the_stream(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = Table(spark, str(tmp_path / "t"), "k", ["ts", "v"], schema)
    sizes, files, folds = [], [], 0
    for n in range(24):  # the same keys over and over
        before = table.folders()
        table.write_changes(spark.createDataFrame([(k, n, f"v{n}-{k}") for k in range(300)], SCHEMA).coalesce(1), n)
        sizes.append(table.size(table.folders()))
        files.append(len(list(pathlib.Path(table.path).rglob("*.parquet"))))
        folds += table.folders()[0] != (before or [""])[0]
    assert sorted(table.read().collect()) == [(k, 23, f"v23-{k}") for k in range(300)]
    assert max(sizes[12:]) <= max(sizes[2:12]) * 1.1 and max(files[12:]) <= max(files[2:12])
    assert 6 <= folds <= 24
