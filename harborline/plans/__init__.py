"""Registered queries: operators applied to the driver's tables, each with its SQL."""
