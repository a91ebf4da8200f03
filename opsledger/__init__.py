"""Operational event analytics as Spark jobs: contracts, state tables, gates, windows, retrieval."""
