"""Operators on documents, triples and graphs, as DataFrame expressions."""
