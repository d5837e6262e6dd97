"""Triggered runs over landing folders and tables."""
