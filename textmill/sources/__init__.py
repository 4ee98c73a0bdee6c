"""Readers, writers and stored artifacts."""
