"""Supply-chain analytics on Spark: typed exports, entities, gates, planning metrics."""
