"""Incremental intake of files that are only ever added."""
