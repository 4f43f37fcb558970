"""Operators on tables of entries, artifacts, documents and links."""
