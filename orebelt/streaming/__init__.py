"""Incremental refresh driven by file streams."""
