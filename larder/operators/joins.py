"""Join helpers: broadcast only behind a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import cut_lineage

#: Most bytes of a table that is broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df`` as text, one aggregate over it."""
    row = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def size_checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast only where its rows take at most
    ``max_bytes``; otherwise unmarked, so that the join is a shuffle join (AQE
    may split its skewed partitions).  The rows are stored reliably first, so
    measuring and joining do not compute them twice and nothing stays cached."""
    kept = cut_lineage(df)
    return F.broadcast(kept) if measured_bytes(kept) <= max_bytes else kept
