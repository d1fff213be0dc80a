"""Readers; each returns a lazy DataFrame."""
