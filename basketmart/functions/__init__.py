"""Column-level helpers: exact money sums, the relative time grid and p-values."""
