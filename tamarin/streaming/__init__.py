"""Structured Streaming twins of the annotation log and the resumable pass."""
