"""Incremental versions of batch rollups."""
