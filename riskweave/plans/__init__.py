"""Compositions of operators: feature table, end-to-end pipeline, query registry."""
