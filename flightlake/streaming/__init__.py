"""Incremental loads with Structured Streaming (file source, availableNow)."""
