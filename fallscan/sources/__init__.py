"""Readers of listings, companies and bars, and the table sink."""
