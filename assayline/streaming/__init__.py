"""Incremental runs of the stateless builds."""

from assayline.streaming.incremental import append_sessions, append_silver, stream_bronze

__all__ = ["append_sessions", "append_silver", "stream_bronze"]
