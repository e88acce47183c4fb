"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``catalog`` holds the registered queries.
"""
