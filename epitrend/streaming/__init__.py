"""Incremental ingestion of report files as they arrive."""

from epitrend.streaming.report_stream import compact_epochs, read_rollup, start_ingest

__all__ = ["compact_epochs", "read_rollup", "start_ingest"]
