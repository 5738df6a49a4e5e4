"""Oracle SQL (DuckDB) for the registered queries, and a local comparer."""
