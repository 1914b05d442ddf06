"""Reusable relational operators built from joins, aggregates and windows."""
