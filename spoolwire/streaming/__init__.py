"""Structured Streaming: unbounded topic reads and the decode-and-emit job."""

from spoolwire.streaming.live import (
    batch_writer,
    drop_resent,
    live_progress,
    read_batches,
    read_progress,
    seen_gaps,
    watch_offsets,
)
from spoolwire.streaming.topic_stream import decode_records, emit_records, run_stream, stream_progress, stream_topic

__all__ = [
    "batch_writer",
    "decode_records",
    "drop_resent",
    "emit_records",
    "live_progress",
    "read_batches",
    "read_progress",
    "run_stream",
    "seen_gaps",
    "stream_progress",
    "stream_topic",
    "watch_offsets",
]
