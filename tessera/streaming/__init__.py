"""Structured Streaming versions of the batch pipeline."""
