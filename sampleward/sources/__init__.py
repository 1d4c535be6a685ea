"""Readers: config objects, catalog tables, command messages."""
