"""Declared schemas, lake paths, readers, writers and append-only state tables."""
