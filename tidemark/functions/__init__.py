"""Column-level helpers: time, text, nested arrays and exact statistics."""
