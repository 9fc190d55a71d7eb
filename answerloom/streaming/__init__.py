"""Merging and scoring run files as they arrive."""
