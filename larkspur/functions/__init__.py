"""Column expressions (no DataFrame, no action)."""
