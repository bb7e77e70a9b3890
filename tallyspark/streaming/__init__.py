"""Structured Streaming drivers for the marts."""
