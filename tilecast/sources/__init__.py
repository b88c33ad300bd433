"""Readers and writers for demand tables."""
