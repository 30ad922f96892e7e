"""Readers, writers and the snapshot tables."""
