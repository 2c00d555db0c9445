"""Whole jobs, the query catalog over the star-schema tables, and plan reports."""
