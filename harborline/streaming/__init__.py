"""Structured Streaming extension; the batch pipeline does not need it."""
