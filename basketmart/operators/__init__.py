"""Reusable DataFrame operators: distributed ordering, quantiles, skew-aware lookups and filters."""
