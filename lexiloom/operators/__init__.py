"""Operators over messages, conversations, samples and tables."""
