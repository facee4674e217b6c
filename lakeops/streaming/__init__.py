"""Structured Streaming ingest, payload parsing and keyed micro-batch merges."""
