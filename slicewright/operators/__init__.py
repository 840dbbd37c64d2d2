"""Reusable relational steps of the slice and load jobs."""
