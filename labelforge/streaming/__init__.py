"""Structured Streaming forms of the parse and scoring jobs."""
