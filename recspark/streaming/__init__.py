"""Incremental forms of the item statistics and the log append."""
