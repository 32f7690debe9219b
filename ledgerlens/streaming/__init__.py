"""Structured Streaming jobs: parse, score, sink, progress."""
