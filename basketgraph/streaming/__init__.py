"""Structured Streaming jobs and sinks."""
