"""Conversation and text corpora on Spark: sources, metrics, selection, merge, reports."""
