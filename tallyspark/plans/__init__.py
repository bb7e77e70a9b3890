"""The marts and the jobs that keep them up to date."""
