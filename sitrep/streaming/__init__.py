"""Incremental versions of the batch plans."""
