"""Structured Streaming feeds and sinks."""
