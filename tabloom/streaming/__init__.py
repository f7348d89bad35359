"""Incremental profiles over files that keep arriving."""
