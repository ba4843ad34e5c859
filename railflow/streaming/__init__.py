"""Structured Streaming entry points."""

from railflow.streaming.changes import fold_into_state, read_change_stream

__all__ = ["fold_into_state", "read_change_stream"]
