"""Every registered query against its DuckDB oracle at sf0.001 (value check),
and the rows-only ones for a stable, non-failing run."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from larder.sources.tables import TABLES
from tests.conftest import SF_SMALL

# Long sweeps; their operators are tested on small frames.
SLOW_ROWS_ONLY = {"kmeans_analysis", "gmm_selection", "clustering_report", "bisecting_analysis", "tfidf_grid_best"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "nan" if isinstance(v, float) and math.isnan(v) else f"{round(float(v), 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "DATE": "date"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql()[name]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    assert {c: t for c, t in df.dtypes} == {c: DUCK_TO_SPARK.get(t, t) for c, t in types.items()}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW_ROWS_ONLY))
def test_rows_only_query_runs(spark, name):
    """Rows, a stable schema, and no column that is empty throughout (but
    those that a law leaves empty)."""
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and len({len(r) for r in rows}) == 1
    filled = {c for c in df.columns if any(r[c] is not None for r in rows)}
    assert set(df.columns) - filled <= {"grown_shard"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
