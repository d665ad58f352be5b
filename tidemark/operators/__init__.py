"""Reusable DataFrame operators: selection, ingestion, windows, labelling."""
