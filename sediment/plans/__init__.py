"""Whole runs: extraction, the layered tables, the warehouse."""
