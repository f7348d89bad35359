"""The registered queries: Spark callables and their SQL twins."""
