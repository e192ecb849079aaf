"""Whole analyses, inputs derived from the driver tables, and the query registry."""
