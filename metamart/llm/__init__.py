"""Operators of a training-data pipeline over the document tables.

Nothing else in the library imports this subpackage; it may be removed
without touching the rest.  ``queries.QUERIES`` and ``queries.ORACLE_SQL``
hold the registered queries.
"""
