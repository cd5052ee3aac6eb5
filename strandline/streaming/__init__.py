"""Incremental state: documents arrive one after another."""
