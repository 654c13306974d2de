"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage; the registered queries
and their SQL live in ``queries.py`` here.
"""
