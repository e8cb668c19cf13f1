"""Layered ingestion and history keeping on Spark DataFrames.

Functions take and return DataFrames; nothing runs on import and the session is
always passed in or taken from the frame.
"""
