"""Structured Streaming forms of the serving and feed operators."""
