"""Operators on Structured Streaming."""
