"""Readers of raw extracts and writers of results."""
