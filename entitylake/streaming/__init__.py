"""Structured Streaming over a growing page lake."""
