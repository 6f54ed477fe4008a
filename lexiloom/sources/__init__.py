"""Readers of chat exports and record files."""
