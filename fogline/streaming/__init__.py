"""Structured Streaming versions of the transit path."""
