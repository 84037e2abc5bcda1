"""Extracts in, entities out."""
