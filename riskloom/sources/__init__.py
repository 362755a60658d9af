"""Readers, writers and the JSON wire format."""
