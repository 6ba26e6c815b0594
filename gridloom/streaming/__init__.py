"""Incremental page indexing with Structured Streaming."""
