"""Snapshot comparison, history, keys and the dimensional model."""
