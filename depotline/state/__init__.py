"""Watermarks, run log and table versions, kept as append-only tables."""
