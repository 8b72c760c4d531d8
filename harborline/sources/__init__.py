"""Readers of exports and files, and sinks."""
