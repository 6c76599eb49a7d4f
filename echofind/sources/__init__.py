"""Readers, writers and run metrics."""
