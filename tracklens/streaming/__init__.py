"""Structured Streaming counterparts of the windowed operators."""
