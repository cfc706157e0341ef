"""Structured Streaming: file ingest and windowed counts."""

from tallywright.streaming.jobs import event_stream, ingest, ingest_table, run_windows, window_counts

__all__ = ["event_stream", "ingest", "ingest_table", "run_windows", "window_counts"]
