"""Views over the benchmark tables, the query catalog and its SQL oracle."""
