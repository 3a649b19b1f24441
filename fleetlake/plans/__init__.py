"""Batch jobs, dashboard queries and the query registry."""
