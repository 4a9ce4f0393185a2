"""Readers for query logs and metric tables, and writers for the results."""
