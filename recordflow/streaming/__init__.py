"""Structured Streaming runners and sinks."""
