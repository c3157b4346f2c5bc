"""Incremental processing on file streams."""
