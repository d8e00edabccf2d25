"""Structured Streaming entry points (incremental landing of monthly files)."""

from legworks.streaming.landing import land_stream

__all__ = ["land_stream"]
