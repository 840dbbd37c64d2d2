"""Slice jobs (DataFrame builders) and load jobs."""
