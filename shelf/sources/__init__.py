"""Readers, writers and the retail view over the star-schema tables."""
