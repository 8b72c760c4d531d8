"""Reusable DataFrame operators: joins, aggregates, windows, reshapes, gates, entities."""
