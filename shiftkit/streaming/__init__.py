"""Structured Streaming variants of batch jobs (incremental over landing folders)."""

from shiftkit.streaming.failures import start_failure_stream

__all__ = ["start_failure_stream"]
