"""Training-data operators: scoring, filtering, deduplication, archives and mixing.

Nothing else in the library imports this subpackage. The operators are plain
functions from DataFrames to DataFrames; ``queries`` binds them to the tables.
"""
