"""Structured Streaming forms of the sync flows."""
