"""Composed jobs: medallion datasets, report queries, optional analytics."""
