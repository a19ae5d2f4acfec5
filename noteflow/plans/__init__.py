"""Pipelines, fixture views and the query registry."""
