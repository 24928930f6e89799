"""Structured Streaming jobs over landed events."""
