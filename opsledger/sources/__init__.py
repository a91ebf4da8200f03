"""Readers and writers for tables, documents and event streams."""
