"""Readers of landed JSON and the extracts built from it."""
