"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` holds
the registered queries, ``queries.ORACLES`` the SQL that DuckDB can run for them.
"""
