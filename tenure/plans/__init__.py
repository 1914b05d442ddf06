"""Pipelines: cleaning, loading, metrics, exploration, gold tables and the report."""
