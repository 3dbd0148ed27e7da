"""Incremental (Structured Streaming) forms of the source cleaning."""
