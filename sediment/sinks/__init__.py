"""Writers: files and tables."""
