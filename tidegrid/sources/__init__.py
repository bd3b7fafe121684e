"""Readers, writers and stored parameters."""
