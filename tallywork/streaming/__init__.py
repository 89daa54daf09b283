"""Structured Streaming forms of the event analyses."""
