"""Column-level building blocks (no data frames, no Python workers)."""
