"""Readers: files, payloads, tables, control data."""
