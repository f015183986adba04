"""Structured Streaming forms of per-record operators."""
