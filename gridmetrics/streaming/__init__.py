"""Structured Streaming form of the bucket roll-up (landed files -> buckets)."""

from .rollup import read_readings_stream, stream_bucket_rollup

__all__ = ["read_readings_stream", "stream_bucket_rollup"]
