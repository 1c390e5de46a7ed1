"""Incremental versions of the merges with Structured Streaming."""
