"""Fact views, metrics, reports, checks and the batch run."""
