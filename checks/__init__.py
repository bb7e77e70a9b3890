"""Registered queries over the sample tables, and the same results in SQL."""
