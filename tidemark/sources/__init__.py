"""Readers of landed files, writers, and the layer tables."""
