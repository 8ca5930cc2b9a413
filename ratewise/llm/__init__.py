"""Operators for training-data pipelines (documents, embeddings, pages).

One module per operator; ``queries.py`` holds the registered queries, ``oracle.py`` their DuckDB
SQL.  Nothing outside this package imports it.
"""
