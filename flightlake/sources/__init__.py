"""Readers and writers. Every name and path is an argument."""
