"""Whole audits as pipelines, and the registered queries with their SQL."""
