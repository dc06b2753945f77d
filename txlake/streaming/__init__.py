"""Structured Streaming side: watermark dedup, the idempotent fan-out sink,
volume metrics and the collector query (the only place a stream starts)."""

from txlake.streaming.dedup import dedup_stream
from txlake.streaming.sinks import (
    FanOutSink,
    TablePaths,
    publish_envelopes,
    write_partitioned,
)
from txlake.streaming.collector import (
    backfill,
    collector_plan,
    run_collector,
    start_collector,
)
from txlake.streaming.metrics import VolumeCheck

__all__ = [
    "dedup_stream",
    "FanOutSink",
    "TablePaths",
    "write_partitioned",
    "publish_envelopes",
    "backfill",
    "collector_plan",
    "run_collector",
    "start_collector",
    "VolumeCheck",
]
