"""Check queries over the given tables: each Spark query with its hand-written SQL twin."""
