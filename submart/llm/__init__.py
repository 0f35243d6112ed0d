"""Operators for training-data pipelines over documents, pages and labels.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` holds the registered
queries and their DuckDB SQL.
"""
