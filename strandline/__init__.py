"""A PySpark engine for knowledge-graph triples extracted from documents."""
