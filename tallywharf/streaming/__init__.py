"""Wiring of the transformations to Structured Streaming."""
