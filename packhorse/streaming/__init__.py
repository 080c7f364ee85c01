"""Structured Streaming: windows, deduplication and sessions with watermarks."""
