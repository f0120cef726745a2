"""Audits over streams of records and edges: their counters are sums, so they can run as data arrives."""
