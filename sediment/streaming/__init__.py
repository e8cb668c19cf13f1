"""Loads driven by arriving files."""
