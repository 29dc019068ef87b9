"""Structured Streaming forms of the stateless encoders."""
