"""Structured Streaming forms of the additive statistics."""
