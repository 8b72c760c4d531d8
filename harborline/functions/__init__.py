"""Column -> Column functions; all native, no UDF."""
