"""Incremental retail and reservation data marts, written as Spark DataFrame plans."""
