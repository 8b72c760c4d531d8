"""Training-data operators: deduplication, scoring, search, mixing, scanning, tokens.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries and their SQL.
"""
