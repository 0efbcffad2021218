"""Incremental flattening of newly landed raw chunks."""
