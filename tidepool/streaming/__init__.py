"""Incremental loads on Structured Streaming (file sources, foreachBatch)."""
