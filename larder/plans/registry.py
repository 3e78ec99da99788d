"""Query registry: name -> Spark plan builder, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query builder; ``sql`` is its DuckDB oracle (None = rows-only)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, cols, digits: int = 9) -> DataFrame:
    """Round order-dependent float results (sums in a different order differ
    in the last bits) to ``digits`` places for stable value comparison."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(c, digits) for c in cols})


def load_all() -> None:
    """Import every plan module so their queries register."""
    from larder.plans import aggregate_queries, catalogue_queries, cluster_queries, dbscan_queries, dense_queries, ingest_queries, misc_queries, model_queries, ranking_queries, recommender_queries, stats_queries, stream_queries, text_queries  # noqa: F401
