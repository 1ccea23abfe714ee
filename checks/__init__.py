"""Check queries: every operator over data derived from the given tables, with SQL oracles."""
