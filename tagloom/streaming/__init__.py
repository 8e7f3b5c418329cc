"""Incremental runs over stored state."""
