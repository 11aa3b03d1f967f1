"""Readers: raw event files, seed files, catalog tables, generated series."""
