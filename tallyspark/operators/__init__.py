"""Reusable DataFrame operators: keys, key replacement, rollups, progress windows, change events."""
