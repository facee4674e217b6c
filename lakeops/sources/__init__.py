"""Batch readers, generated series and sinks."""
