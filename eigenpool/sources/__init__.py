"""Readers, writers and seeded generators for owner tables."""
