"""Compositions of operators: the ingest run and the registered queries."""
