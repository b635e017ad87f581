"""Structured Streaming source and sink."""
