"""Readers, writers and catalogue tables."""
