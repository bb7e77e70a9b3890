"""Operators for preparing training text, each with its registered query. Nothing else in the library imports these."""
