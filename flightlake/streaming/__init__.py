"""Continuous jobs on Structured Streaming; each has a batch twin."""
