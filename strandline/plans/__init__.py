"""Whole plans: triples derived from tables, and the queries on them with their SQL."""
