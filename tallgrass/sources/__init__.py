"""Readers, writers, catalog helpers and generated sources."""
