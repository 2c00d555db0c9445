"""Inputs and outputs: CSV orders, star-schema tables, result files, shared folder."""
