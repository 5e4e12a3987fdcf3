"""metamart: a metadata-driven measure warehouse on Spark DataFrames.

Wide landing files are unpivoted into a long bronze table, checked by
data-quality rules stored as rows, joined to a column-mapping table
(silver), published as a star schema (gold) and read through measures
that respect a filter context.  Every step is a set-based DataFrame job
over all sources at once.
"""

__version__ = "0.1.0"
