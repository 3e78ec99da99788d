"""Streaming query (X1): the incrementally maintained table equals the batch result."""

from __future__ import annotations

from larder.plans.registry import ORACLE, register
from larder.streaming.ingest_stream import stream_latest_events


@register("stream_latest_events")
def q_stream_latest_events(spark, sf_dir):
    return stream_latest_events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")


# The streamed table must equal the batch "latest event per user".
ORACLE["stream_latest_events"] = """
select user_id, event_id, ts, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1"""
