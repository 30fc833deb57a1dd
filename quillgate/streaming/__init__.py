"""Structured Streaming runs of the stateless stages."""
